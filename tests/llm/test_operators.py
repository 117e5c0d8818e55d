"""Each operator against a brute-force version on a small table of hard cases, and on no rows."""

import hashlib
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from apiary.llm import bpe, exact_dedup, jaccard_join, licenses, mixing, neighbours, quality, sharding, substring_dedup, token_counts
from apiary.llm.common import stage
from llm_rows import rows

SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def table(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def test_exact_dedup(docs, no_docs):
    groups = {}
    for i, t, *_ in rows():
        groups.setdefault(lower(t), []).append(i)
    got = exact_dedup.exact_dedup(docs, keep="largest").collect()
    assert len(got) == len(rows())
    by_sha = {hashlib.sha256(t.encode()).digest(): ids for t, ids in groups.items()}
    for r in got:
        ids = by_sha[bytes(r._sha)]
        known = [i for i in ids if i is not None]
        assert (r.group_size, r.keep_id) == (len(ids), max(known) if known else None)
    assert sum(r.kept for r in got) == len(groups)
    assert exact_dedup.exact_dedup(no_docs).count() == 0
    kept = exact_dedup.keep_one(docs, keep="largest")
    assert kept.columns == docs.columns and kept.count() == len(groups)


def test_sharding(docs, no_docs):
    got = sorted(sharding.shard_by_bytes(docs, 4).collect(), key=lambda r: (r.shard, r.slot))
    assert len(got) == len(rows())
    assert [r.first_byte for r in got] == np.concatenate([[0], np.cumsum([r.size for r in got])[:-1]]).tolist()
    total = sum(r.size for r in got)
    assert all(r.shard == r.first_byte * 4 // total for r in got)
    assert sharding.shard_by_bytes(no_docs).count() == 0


def test_bpe_equals_the_library_and_round_trips(docs, no_docs):
    path = bpe.default_path()
    lib = Tokenizer.from_file(path)
    got = bpe.decode(bpe.encode(docs, path), path)
    want = []
    for i, t, *_ in rows():
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((i, tuple(ids), lib.decode(ids, skip_special_tokens=False)))
    assert Counter((r.doc_id, tuple(r.ids), r.text) for r in got.collect()) == Counter(want)
    assert bpe.digests(no_docs, path).count() == 0


def test_bpe_merges_equal_the_library_on_random_pieces():
    rng = np.random.default_rng(3)
    b = bpe.Bpe(bpe.default_path())
    lib = Tokenizer.from_file(bpe.default_path())
    texts = ["".join(rng.choice(list("abcdeht '\n1é漢!"), size=n)) for n in rng.integers(0, 90, 1500)]
    got = bpe.Encoder(b).encode([t.encode() for t in texts])
    assert [g.tolist() for g in got] == [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]


def test_token_counts(docs, no_docs):
    path = bpe.default_path()
    vocabulary = set(token_counts.byte_level_pieces(path))

    def greedy(word):
        word, n, at = b" " + word, 0, 0
        while at < len(word):
            end = len(word)
            while word[at:end] not in vocabulary:
                end -= 1
            at, n = end, n + 1
        return n

    want = []
    for i, t, *_ in rows():
        words = (t or "").encode().split()
        want.append((i, len(words), sum(map(greedy, words))))
    assert table(token_counts.token_counts(docs, path), "doc_id", "n_words", "n_tokens") == Counter(want)
    assert token_counts.token_counts(no_docs, path).count() == 0
    # A word the vocabulary cannot cover is one unknown token.
    few = token_counts.PieceAutomaton([b"ab", b"abc", b"d"], marker=b"")
    data = np.frombuffer(b"abcd abx abab", dtype=np.uint8)
    assert few.count(data, np.array([0, 5, 9]), np.array([4, 8, 13])).tolist() == [2, 1, 2]


def test_substring_dedup(docs, no_docs):
    for window in (50, 4):
        last = 1 << 62
        words = [(last if i is None else i, SPACED.findall(t or "")) for i, t, *_ in rows()]
        lowest = {}
        for i, w in words:
            for a in range(len(w) - window + 1):
                key = tuple(w[a : a + window])
                lowest[key] = min(i, lowest.get(key, i))
        want = []
        for i, w in words:
            gone = {x for a in range(len(w) - window + 1) if lowest[tuple(w[a : a + window])] < i for x in range(a, a + window)}
            kept = " ".join(x for k, x in enumerate(w) if k not in gone)
            want.append((None if i == last else i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
        got = substring_dedup.remove_repeats(docs, window)
        assert table(got, "doc_id", "n_words", "n_removed", "kept_sha256") == Counter(want)
    assert substring_dedup.remove_repeats(no_docs).count() == 0


def test_substring_lists_stay_within_a_row(spark, monkeypatch):
    """Rows that share an id, or have none, never carry each other's anchors and windows."""
    staged = {}
    monkeypatch.setattr(substring_dedup, "stage", lambda df, name, *a, **b: staged.setdefault(name, stage(df, name, *a, **b)))
    texts = [" ".join(f"t{k}w{i}" for i in range(60)) for k in range(30)]
    made = [(1 + k, t) for k, t in enumerate(texts)] + [(None, t) for t in texts] + [(99, t) for t in texts]
    got = substring_dedup.remove_repeats(spark.createDataFrame(made, "doc_id long, text string").repartition(3))
    assert Counter((r.doc_id, r.n_removed) for r in got.collect()) == Counter(
        [(1 + k, 0) for k in range(30)] + [(None, 60)] * 30 + [(99, 60)] * 30
    )
    candidates = staged["window-candidates"]
    assert candidates.count() == 90
    assert candidates.agg(F.max(F.size("_anchors"))).first()[0] <= 60 - substring_dedup.WINDOW + 1


def test_mixing(docs, no_docs):
    mix = mixing.Mix(docs, block=16)
    got = mix.per_document().collect()
    assert sorted(r.size for r in got) == sorted(len(SPACED.findall(t or "")) for _, t, *_ in rows())
    assert all(r.taken <= 2 * r.size for r in got)
    total = sum(r.size for r in got)
    targets = {(r.source_size, r.target) for r in got}
    assert abs(sum(r.taken for r in got) - 1.5 * total) <= len(targets)
    assert table(mix.per_document(), "doc_id", "size", "taken") == table(mixing.Mix(docs.repartition(7), block=16).per_document(), "doc_id", "size", "taken")
    mixed = mixing.mixed_documents(docs, block=16)
    assert mixed.columns == docs.columns
    assert sum(len(SPACED.findall(r.text)) for r in mixed.collect()) == sum(r.taken for r in got)
    assert mixing.Mix(no_docs).per_document().count() == 0


def test_blocks_of_a_shard_are_those_drawn_for_it(docs):
    mix = mixing.Mix(docs, block=16, shard_words=700)
    blocks = mix.blocks().collect()
    taken = mix.per_document().collect()
    total = {(r.source_size, r.target) for r in taken}
    shards = -(-int(sum(t for _, t in total)) // 700)
    assert shards > 5 and {r.shard for r in blocks} <= set(range(shards))
    got, want = Counter((r._sid, r.shard) for r in blocks), Counter()
    for sid in {r._sid for r in blocks}:
        size, target = next((r.source_size, r.target) for r in mix.placed.where(f"_sid = {sid}").collect())
        _, slots, _ = mixing._plan(size, target, 16, mixing.MOST)
        drawn = mixing._seed("mix", "shards", sid).multinomial(slots, np.full(shards, 1.0 / shards))
        want.update({(sid, k): int(n) for k, n in enumerate(drawn) if n})
    assert got == want
    assert all(r.words <= 16 and r.words == sum(x.words for x in r.runs) for r in blocks)
    # another deal of the same slots: the same words are taken
    assert sum(r.words for r in blocks) == sum(r.taken for r in taken)


def test_permutation_is_one():
    for n in (1, 2, 3, 17, 1000):
        assert sorted(mixing.permute(np.arange(n), n, "seed", 1).tolist()) == list(range(n))


def test_jaccard_groups(docs, no_docs):
    for n, num, den in ((3, 9, 10), (5, 4, 5)):
        sets = []
        for i, t, *_ in rows():
            w = SPACED.findall(lower(t))
            sets.append((i, {tuple(w[a : a + n]) for a in range(max(1, len(w) - n + 1))} if w else set()))
        label = list(range(len(sets)))
        for a in range(len(sets)):
            for b in range(a):
                x, y = sets[a][1], sets[b][1]
                if x and y and den * len(x & y) >= num * len(x | y):
                    label = [label[b] if v == label[a] else v for v in label]
        want = []
        for k, (i, s) in enumerate(sets):
            ids = [sets[j][0] for j in range(len(sets)) if label[j] == label[k] and sets[j][0] is not None]
            want.append((i, len(s), min(ids) if ids else None))
        got = jaccard_join.jaccard_groups(docs, n, num, den)
        assert table(got, "_id", "n_shingles", "component_id") == Counter(want)
    assert jaccard_join.jaccard_groups(no_docs).count() == 0


def test_large_block_is_split_and_joined(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CHUNK", 5)
    base = [f"w{i}" for i in range(100)]
    made = [(k, " ".join([*base[:50], f"x{k}", *base[50:]])) for k in range(23)]
    got = jaccard_join.jaccard_groups(spark.createDataFrame(made, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {0}


def test_jaccard_links(spark, docs, monkeypatch):
    """Every link counts once for either side: chains, copies, and pairs within and across chunks."""
    monkeypatch.setattr(jaccard_join, "CHUNK", 3)
    words = [f"w{i}" for i in range(90)]
    chain = [" ".join([*(f"x{i}" for i in range(k)), *words[k:]]) for k in range(0, 24, 2)]
    made = [(k % 9 or None, t) for k, t in enumerate([*chain, *chain[3:6], chain[4].upper()])]
    made = spark.createDataFrame(made, "doc_id long, text string").repartition(3)
    for table_, n, num, den in ((made, 3, 9, 10), (docs, 3, 9, 10), (docs, 5, 4, 5)):
        sets = []
        for r in table_.collect():
            w = SPACED.findall(lower(r.text))
            sets.append((r.doc_id, {tuple(w[a : a + n]) for a in range(max(1, len(w) - n + 1))} if w else set()))
        want = []
        for k, (i, s) in enumerate(sets):
            same = [j for j, t in sets if t == s and j is not None] if s else [i]
            links = sum(j != k and den * len(s & t) >= num * len(s | t) for j, (_, t) in enumerate(sets)) if s else 0
            want.append((i, min(same) if same else None, links))
        got = jaccard_join.jaccard_groups(table_, n, num, den)
        assert table(got, "_id", "class_id", "n_links") == Counter(want)


def test_long_words_with_one_polynomial_are_told_apart(spark):
    """Thue-Morse words and their complements: equal polynomials modulo 2**64 in every odd base."""
    x = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    y = "".join("ba"[bin(i).count("1") % 2] for i in range(1024))
    made = [(1, " ".join([x] * 60)), (2, " ".join([y] * 60)), (3, f"{x} {x}"), (4, f"{y} {y}")]
    df = spark.createDataFrame(made, "doc_id long, text string")
    assert {r.n_removed for r in substring_dedup.remove_repeats(df).collect()} == {0}
    assert all(r.component_id == r._id and r.n_links == 0 for r in jaccard_join.jaccard_groups(df).collect())


def test_subtrees_that_cannot_link_are_cut(monkeypatch):
    """Sets that share a beginning but whose sizes lie too far apart: nothing below the shared node is walked."""
    walked = []
    walk = jaccard_join.Trie._walk

    def spy(self, shared, path, begin, end, most, least, possible, own):
        walked.append(len(own))
        return walk(self, shared, path, begin, end, most, least, possible, own)

    monkeypatch.setattr(jaccard_join.Trie, "_walk", spy)
    tokens = [np.arange(n, dtype=np.uint64) << np.uint64(40) for n in (10, 20, 40, 80)]
    sizes = np.array([len(t) for t in tokens])
    counts = np.zeros(jaccard_join.CELLS, dtype=np.int32)
    assert list(jaccard_join.Trie(tokens, sizes, counts, 9, 10).partners()) == []
    assert walked == [4]
    near = [*tokens, tokens[3][:78]]
    found = dict(jaccard_join.Trie(near, np.array([len(t) for t in near]), counts, 9, 10).partners())
    assert {k: v.tolist() for k, v in found.items()} == {3: [4], 4: [3]}


def test_heavy_blocks_are_split_by_tokens(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CHUNK_TOKENS", 300)
    monkeypatch.setattr(jaccard_join, "FEW", 2)
    base = [f"w{i}" for i in range(100)]
    made = [(k, " ".join([*base[:50], f"x{k}", *base[50:]])) for k in range(17)]
    got = jaccard_join.jaccard_groups(spark.createDataFrame(made, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {0} and {r.n_links for r in got} == {16}


def test_other_characters_take_the_batched_path(monkeypatch):
    """Curly quotes, dashes, CJK and added tokens: equal to the library, without the piece-by-piece path."""
    path = bpe.default_path()
    lib = Tokenizer.from_file(path)
    words = ["“quoted”", "it’s", "—", "漢字かな", "plain", "don't", "…", "😀", "é", "１２", "<|endoftext|>", "  ", "\u3000x"]
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(words, 30)) if i % 2 else " ".join(rng.choice(words, 30)) for i in range(60)]
    monkeypatch.setattr(bpe.Encoder, "_encode_one", lambda *_: 1 / 0)
    encoder = bpe.Encoder(bpe.load(path))
    for _ in range(2):  # the second time from memory
        got = encoder.encode([t.encode() for t in texts])
        assert [g.tolist() for g in got] == [lib.encode(t, add_special_tokens=False).ids for t in texts]
    data = np.frombuffer(b" late early mid", dtype=np.uint8)
    ids, count = bpe.load(path).encode_pieces(data, np.array([11, 0, 5]), np.array([15, 5, 11]))
    assert count.tolist() == [1, 1, 1] and ids.tolist() == [lib.encode(t, add_special_tokens=False).ids[0] for t in (" mid", " late", " early")]


def test_characters_are_classed_as_the_library_does():
    """Characters of every plane, white space of every kind, combining marks: pieces equal the library's."""
    path = bpe.default_path()
    lib = Tokenizer.from_file(path)
    rng = np.random.default_rng(8)
    known = [*"ab1! '\t\n\r\x0b\x0c\x1c\x85\xa0\u1680\u2002\u2028\u202f\u3000\u200b\ufeff’“—漢한か१Ⅷ①ªא\u0301\u0903\U0001f9d1\u200d"]
    anything = [chr(c) for c in rng.integers(0x80, 0x110000, 3000).tolist() if not 0xD800 <= c < 0xE000]
    texts = ["".join(rng.choice(known + anything[i * 5 : i * 5 + 5], 25)) + "'s" for i in range(500)]
    got = bpe.Encoder(bpe.load(path)).encode([t.encode() for t in texts])
    assert [g.tolist() for g in got] == [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]


def test_license_scan(docs, no_docs):
    got = {(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.scan(docs).collect()}
    assert (13, 13, 3, 2, 10, "cc-by,gpl,reserved") in got and (0, 0, 0, None, None, "") in got
    assert licenses.scan(docs).count() == len(rows()) and licenses.scan(no_docs).count() == 0


def brute_scan(text):
    words = [w for w in re.split(licenses.SEPARATORS, lower(text)) if w]
    places, labels, base_labels, score = [], set(), set(), 0.0
    for phrase, label in licenses.BASE_PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += at
        base_labels |= {label} if at else set()
    labels |= base_labels
    for phrase, label in licenses.NOTICES.items():
        p = phrase.split()
        meets = {}
        for i in range(len(words) - 1):
            for k in range(len(p) - 1):
                if words[i : i + 2] == p[k : k + 2]:
                    meets.setdefault(i - k, set()).add(k)
        spans = []
        for d in sorted(meets):
            if spans and d - spans[-1][-1] <= licenses.NEIGHBOUR:
                spans[-1].append(d)
            else:
                spans.append([d])
        for span in spans:
            ends = [d + k for d in span for k in meets[d]]
            whole = max(ends) - min(ends) + 1 <= 2 * (len(p) - 1) + licenses.NEIGHBOUR
            met = len(set().union(*(meets[d] for d in span))) if whole else max(len(meets[d]) for d in span)
            if met / (len(p) - 1) >= licenses.LEAST:
                labels.add(label)
                score = max(score, met / (len(p) - 1))
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base_labels)), ",".join(sorted(labels)), 1.0 if base_labels else score)


def test_license_scan_equals_brute_force(spark, docs):
    mit = next(p for p in licenses.NOTICES if p.startswith("permission") and len(p) > 200)
    apache = "Licensed under the Apache License, Version 2.0"
    cut = mit.split()
    texts = [
        "under the bed " * 4, "under the bed " * 6, "under the bed " * 400, mit, f"x {mit.upper()} y", " ".join(cut[:20] + ["extra"] + cut[20:]),
        " ".join(cut[: len(cut) // 2]), f"{apache} {apache} under the under the", f"all all rights reserved all rights reserved cc by cc, by",
        "released under the mit released under the license mit", mit.replace("software", "thing"), "by cc general public general public license",
    ]
    made = [(i, t) for i, t, *_ in rows()] + [(1000 + i, t) for i, t in enumerate(texts)]
    got = licenses.scan(spark.createDataFrame(made, "doc_id long, text string").repartition(3))
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    assert table(got, *names) == Counter((i, *brute_scan(t)) for i, t in made)
    clean = {r.doc_id: r.labels for r in got.collect()}
    assert clean[1000] == clean[1001] == clean[1002] == "" and clean[1003] == clean[1005] == "mit"


def test_nearest_recall_and_cases(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 24))
    x[7] = x[3]
    made = [(i, v.tolist()) for i, v in enumerate(x)]
    made += [(1500, None), (1501, [0.0] * 24), (1502, [float("nan")] * 24), (1503, [None] * 24), (None, x[0].tolist()), (3, x[3].tolist())]
    df = spark.createDataFrame(made, "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, F.col("_id") % 50 == 0, block=400).collect()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 1500, 50):
        c = unit @ unit[q]
        c[q] = -2
        hits += len(set(np.argsort(-c)[:5].tolist()) & {r.vec_id for r in got if r.query_id == q})
    assert len(got) == 150 and hits >= 0.9 * 150
    few = neighbours.nearest(df.where("vec_id < 3"), F.col("_id") == 0).collect()
    assert sorted(r.rank for r in few) == [1, 2]
    assert neighbours.nearest(df.where("false"), F.col("_id") == 0).count() == 0


def test_quality_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    scored = quality.score(docs, quality.train(docs, labels)).where("held_out").join(labels, "doc_id")
    right = scored.where("predicted = quality").count()
    assert right >= 0.95 * scored.count() > 0


def test_quality_cases(spark, docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.train(docs, none)
    assert {r.score for r in quality.score(docs, model).collect()} == {0.5}
    assert quality.score(no_docs, model).count() == 0
    assert quality.keep_good(docs, model).columns == docs.columns
    # The sum-of-squares identity equals the sum over pairs.
    x = quality.featurize([b"some words, some MORE"], [21])
    rng = np.random.default_rng(1)
    m = quality.Model(0.1, rng.normal(size=quality.INPUTS), rng.normal(size=(quality.INPUTS, quality.RANK)))
    slots = [*zip(x.slot, x.value), *((s, quality.LEVEL_VALUE) for s in x.levels[0])]
    raw = 0.1 + sum(m.linear[s] * v for s, v in slots)
    raw += sum(m.factors[a] @ m.factors[b] * u * v for k, (a, u) in enumerate(slots) for b, v in slots[:k])
    assert abs(m._sums(x)[0][0] - raw) < 1e-9
