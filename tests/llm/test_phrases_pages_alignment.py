"""Collocations, page texts and alignment against brute force, on hard cases and on no rows."""

import hashlib
import html
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from apiary.llm import alignment, bpe, collocations, main_text
from llm_rows import rows

PIECE = re.compile(r"[.,;:!?\x0A-\x0D]")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


# Collocations


def brute_phrases(table, longest):
    f, n = defaultdict(Counter), Counter()
    for lang, text in table:
        for piece in PIECE.split(lower(text)):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            n[lang or "und" if lang is None else lang] += len(w)
            for k in range(1, longest + 1):
                f["und" if lang is None else lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    return f, n


def brute_collocations(table, longest, least, first):
    f, n = brute_phrases(table, longest)
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        rows_ = []
        for p, a in candidates.items():
            inside = any(
                len(q) > len(p) and 100 * b >= 100 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in candidates.items()
            )
            if not inside:
                cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                rows_.append((-score, -a, " ".join(p).encode(), " ".join(p), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, _, p, left, right) in enumerate(sorted(rows_)[:first], 1):
            out.append((lang, rank, p, -a, left, right, n[lang], -s))
    return Counter(out)


def phrase_table():
    rng = np.random.default_rng(2)
    words = ["the", "New", "new", "york", "ÉTÉ", "été", "漢字", "a.b", "x", "and,then", "o\x00p", "z z"]
    out = [(None, None), ("en", ""), ("en", " \t\n"), (None, "one Two one two! one two"), ("", "x x x x x x x x")]
    out += [("en", " ".join(rng.choice(words, 40))) for _ in range(60)] * 2
    out += [("fr", "\t".join(rng.choice(words[:5], 30))) for _ in range(30)]
    return out + [("hot", "same words here " * 400), ("hot", "same words here " * 400)]


def test_collocations(spark):
    made = phrase_table()
    docs = spark.createDataFrame([(lang, t, 1, "c") for lang, t in made], "lang string, text string, phrase int, f string").repartition(3)
    got = collocations.collocations(docs, 5, 6, 25)
    assert Counter(map(tuple, got.collect())) == brute_collocations(made, 5, 6, 25)
    assert collocations.collocations(docs.limit(0)).count() == 0


def test_full_filters_change_no_count(spark):
    made = phrase_table()
    got = collocations.frequent_phrases(spark.createDataFrame(made, "lang string, text string"), 3, 6, bits=64)
    f, n = brute_phrases(made, 3)
    want = {(lang, " ".join(p), a) for lang, c in f.items() for p, a in c.items() if a >= 6}
    assert {(r.lang, r.phrase, r.f) for r in got.where("words > 0").collect()} == want
    assert {r.lang: r.f for r in got.where("words = 0").collect()} == {k: v for k, v in n.items() if v}


def test_counts_with_little_memory(monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK", 37)
    made = phrase_table()
    f, _ = brute_phrases(made, 5)
    batches = [
        pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in part], pa.string()).cast(pa.binary()), pa.array([x[1] for x in part], pa.string()).cast(pa.binary())],
            ["lang", "text"],
        )
        for part in (made[:50], made[50:])
    ]
    everything = np.full(16, 2**64 - 1, dtype=np.uint64)
    for n in range(1, 6):
        got = Counter()
        for run in collocations.PhraseCounter(n, everything, kept=50, remembered=9, burst=2)(iter(batches)):
            at = [(r["lang"], r["phrase"].encode()) for r in run.to_pylist()]
            assert at == sorted(at)
            for r in run.to_pylist():
                got[r["lang"], r["phrase"]] += r["f"]
        assert got == Counter({(lang, " ".join(p)): a for lang, c in f.items() for p, a in c.items() if len(p) == n})


def test_burst_trie_spills_whole_subtrees():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 4, 5):
        trie, want, got = collocations.BurstTrie(n, burst=3), Counter(), Counter()
        for _ in range(40):
            block = [rng.integers(0, 4, 60), *(rng.integers(1, 6, 60) for _ in range(n))]
            columns, counts = collocations._distinct(block)
            assert counts.sum() == 60
            trie.add(columns, counts)
            want.update(zip(*(c.tolist() for c in block)))
            if trie.entries > 100:
                spilled, f = trie.spill(50)
                rows_ = list(zip(*(c.tolist() for c in spilled)))
                assert len(rows_) == len(set(rows_))
                got.update(dict(zip(rows_, f.tolist())))
        spilled, f = trie.spill(0)
        got.update(dict(zip(zip(*(c.tolist() for c in spilled)), f.tolist())))
        assert got == want and trie.entries == 0 and not trie.root


def test_scores_beyond_64_bits_are_exact(spark, monkeypatch):
    n, a, left, right = 4 * 10**13, 3 * 10**12, 3 * 10**12 + 7, 5 * 10**12 + 1
    f = [("en", "", 0, n), ("en", "p", 1, left), ("en", "q", 1, right), ("en", "p q", 2, a)]
    found = spark.createDataFrame(f, "lang string, phrase string, words int, f long")
    monkeypatch.setattr(collocations, "frequent_phrases", lambda *_: found)
    assert collocations.collocations(found).first().score == 1000 * a * n // (left * right)


# Page texts

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style></head><body class="has-sidebar">
<nav><ul><li><a href="/a">Home</a></li><li><a href='/b'>News</a></li></ul></nav><div class="ad">Buy this now.</div>
<article><h1>Head&nbsp;line</h1><p>One <b>bo</b>ld word
  and <a href=x>linked words</a> here.<br>After &lt;break&gt; &#233;&eacute;.<p>Second paragraph, not closed <script>var t="</p>";</script>
<div class="adBox">Advert in the middle</div><ul><li>first thing<li>second thing</ul><!-- hidden </article> -->
<table><tr><td>cell a<td>cell b</table></article><aside>Aside words</aside><section id="comments"><p>A reader says much more than
the article does, and says it at length, in many many words.</p></section><form><label>Name</label><input></form>
<footer>&copy; Foot</footer>"""
TEXT = ("Head line One bold word and linked words here. After <break> éé. Second paragraph, not closed "
        "first thing second thing cell a cell b")


def weights():
    pages = [PAGE, PAGE.replace("One", "Two words more and more"), PAGE.replace('class="ad"', 'class="x"')]
    total = defaultdict(lambda: [0, 0])
    for p in pages:
        for kind, (a, b) in main_text.tally(main_text.read(p)).items():
            total[kind][0] += a
            total[kind][1] += b
    return main_text.Weights({k: tuple(v) for k, v in total.items()})


def test_main_text_of_marked_and_unmarked_pages():
    w = weights()
    assert main_text.main_text(PAGE, w) == TEXT
    unmarked = PAGE.replace("<article>", "<div>").replace("</article>", "</div>")
    assert main_text.main_text(unmarked, w) == TEXT
    assert main_text.main_text(PAGE.upper().replace("&NBSP;", "&nbsp;").replace("&LT;", "&lt;").replace("&GT;", "&gt;")
                               .replace("&EACUTE;", "&eacute;").replace("&COPY;", "&copy;").replace("&AMP;", "&amp;"), w).startswith("HEAD LINE ONE BOLD WORD")


@pytest.mark.parametrize("source, text", [
    (None, ""), ("", ""), (" \n ", ""), ("<", "<"), ("<!-- never closed", ""), ("<script>var a = 1", ""),
    ("<p>only words &amp; no page", "only words & no page"), ("plain &lt;text&gt;", "plain <text>"),
    ("<p>a<p>b</p></p>c", "a b c"), ('<p title="a > b">quoted</p>', "quoted"), ('<p title="never closed>words', ""),
    ("<div hidden>no</div><p>yes", "yes"), ("<p>x</p><div style='display: none'>no</div><p>y</p>", "x y"),
    ("<article></article>", ""), ("<nav>menu only</nav>", ""), ("</p></div></html>", ""),
    ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"), ("<p>&am<b>p;</b></p>", "&amp;"),
])
def test_main_text_cases(source, text):
    got = main_text.main_text(source, main_text.Weights({}))
    assert got == text or (text == "" and source and "never closed>" in source and got in ("", "words"))


def test_best_region_equals_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(200):
        s = rng.integers(-4, 4, rng.integers(0, 12)).tolist()
        lo, hi = main_text.best_region(s)
        want = max([0, *(sum(s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1))])
        assert sum(s[lo:hi]) == want and (want > 0 or lo == hi)


def test_main_text_of_the_test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    learnt = main_text.train(pages)
    assert learnt.kind["in p"] > 0 and all(v < 0 for k, v in learnt.kind.items() if k.startswith("<"))
    got = {r.page_id: r for r in main_text.extract(pages, learnt).collect()}
    blind = 0
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        want = " ".join(html.unescape(re.sub(r"</?b>", "", inner).replace("<", " <") and re.sub(r"<[^>]+>", " ", re.sub(r"</?b>", "", inner))).split())
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want)
        blind += main_text.main_text(r.html.replace("article>", "div>"), learnt) == want
    # without the mark the scan alone finds the region
    assert blind >= 0.98 * len(got)


def test_pages_with_nulls_repeats_and_other_columns(spark):
    made = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, None), (2, None, "", "y"), (3, "v", "<p>long " + "word " * 50_000, "z")]
    pages = spark.createDataFrame(made, "page_id long, url string, html string, text string")
    got = main_text.extract(pages, main_text.train(pages)).collect()
    assert Counter((r.page_id, r.url, r.n_chars) for r in got) == Counter(
        [(1, "u", len(TEXT))] * 2 + [(None, None, 0), (2, None, 0), (3, "v", len("long " + "word " * 50_000) - 1)]
    )
    assert main_text.extract(pages.limit(0), main_text.train(pages.limit(0))).count() == 0


# Alignment


def brute_alignment(table):
    pair = alignment.load(bpe.default_path(), alignment.piece_path())
    counts, found = Counter(), []
    for i, text in table:
        none = (i, 0, 0, 0, [], "")
        if not text:
            found.append(none)
            continue
        a, b = pair.a.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text)
        raw = (" " + text).encode()
        if pair.joined(pair.bytes_a, np.array(a)) != raw or pair.joined(pair.bytes_b, np.array(b, dtype=int)) != raw:
            found.append(none)
            continue
        ends = [np.cumsum([len(t[k]) for k in ids]).tolist() for t, ids in ((pair.bytes_a, a), (pair.bytes_b, b))]
        both = set(ends[0]) & set(ends[1])
        sides = []
        for ids, end in zip((a, b), ends):
            cut = [[]]
            for k, e in zip(ids, end):
                cut[-1].append(str(k))
                if e in both:
                    cut.append([])
            sides.append(cut[:-1])
        groups = ";".join(",".join(x) + "|" + ",".join(y) for x, y in zip(*sides))
        links = [(x, y) for x, e in zip(a, ends[0]) for y, g in zip(b, ends[1]) if e == g] if len(a) < 2000 else [
            (dict(zip(ends[0], a))[e], dict(zip(ends[1], b))[e]) for e in sorted(both)]
        counts.update(links)
        found.append((i, len(a), len(b), len(both), links, hashlib.sha256(groups.encode()).hexdigest()))
    most = defaultdict(int)
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return Counter(
        (i, n_a, n_b, n_g, len(links), sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links), sha)
        for i, n_a, n_b, n_g, links, sha in found
    )


ODD = ["a  b", " lead", "trail ", " ", "  ", "\n", "a\n b", "tab\tx \t y", "x▁y", "  nb  ", "don't  we'll ’tis", "<|endoftext|> x",
       "</s><s> <unk>", "漢字 かな 😀 \U0001f9d1‍\U0001f680", "é ﬁ Å ①", "a\r\n\r\nb \x00 \x1c c", "word" * 400, "　wide　 ", "<0x41> ▁"]


@pytest.mark.parametrize("hot", [1, 40, alignment.HOT])
def test_alignment(spark, docs, hot):
    made = [(i, t) for i, t, *_ in rows()] + [(100 + i, t) for i, t in enumerate(ODD)]
    df = spark.createDataFrame([(i, t, 1, "g") for i, t in made], "doc_id long, text string, pair int, groups string").repartition(3)
    assert Counter(map(tuple, alignment.link_counts(df, hot=hot).collect())) == brute_alignment(made)


def test_alignment_of_no_rows_and_with_little_memory(spark, monkeypatch):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.link_counts(empty).count() == 0
    pair = alignment.load(bpe.default_path(), alignment.piece_path())
    small, large = alignment.Aligner(pair, remembered=3), alignment.Aligner(pair)
    texts = [t for _, t, *_ in rows()] + ODD
    for t in texts:
        (a,), (b,) = ([al.align(p) for p in al.prepare([t])] for al in (small, large))
        assert a[0].tolist() == b[0].tolist() and a[1] == b[1] and a[2].tolist() == b[2].tolist()


def test_coalesce_and_overlaps_equal_brute_force():
    rng = np.random.default_rng(7)
    for _ in range(100):
        total = int(rng.integers(1, 30))
        sides = []
        for _ in range(2):
            cuts = np.unique(np.concatenate([rng.integers(0, total + 1, rng.integers(0, 12)), [0, total]]))
            sides += [cuts[:-1], cuts[1:]]
        groups = alignment.coalesce(*sides)
        both = sorted(set(sides[1].tolist()) & set(sides[3].tolist()))
        assert groups.n == len(both)
        assert groups.group_a.tolist() == [int(np.searchsorted(both, e)) for e in sides[1]]
        assert groups.group_b.tolist() == [int(np.searchsorted(both, e)) for e in sides[3]]
        a, b = alignment.overlaps(*sides)
        want = [(i, j) for i in range(len(sides[0])) for j in range(len(sides[2])) if sides[0][i] < sides[3][j] and sides[2][j] < sides[1][i]]
        assert sorted(zip(a.tolist(), b.tolist())) == want


def test_runs_of_buckets_are_merged():
    counter = collocations.BucketCounter(2)
    counter.held, counter.counts = np.array([1, 5, collocations.SEGMENT + 7]), np.array([60, 99, 100])
    first = list(counter.finish())
    counter.held, counter.counts = np.array([1, collocations.SEGMENT + 8]), np.array([40, 1])
    runs = sorted(
        (s, r) for b in [*first, *counter.finish()] for s, r in zip(b.column(0).to_pylist(), b.column(1).to_pylist())
    )
    batch = pa.RecordBatch.from_arrays([pa.array([s for s, _ in runs], pa.int32()), pa.array([r for _, r in runs])], ["segment", "run"])
    out = {b.column(0)[0].as_py(): np.unpackbits(np.frombuffer(b.column(1)[0].as_py(), np.uint8), bitorder="little") for b in collocations.merge_buckets(100)([batch])}
    assert np.flatnonzero(out[0]).tolist() == [1] and np.flatnonzero(out[1]).tolist() == [7]
