"""The registered queries on the small tables: SQL, plans without Python, recall, and the pipeline as a whole."""

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from apiary.llm import bpe, mixing, quality, queries
from apiary.session import work_path

SMALL = "/root/testdata/sf0.001"
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def rows_of(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def test_all_queries_are_registered():
    names = set(queries.QUERIES) | {"pipeline"}
    assert names <= set(entry.queries()) and set(queries.ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SMALL}/documents.parquet')")
    got = entry.queries()[name](spark, SMALL)
    want = con.sql(entry.oracle_sql()[name])
    at = sorted(range(len(want.columns)), key=lambda i: want.columns[i])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == Counter(tuple(r[i] for i in at) for r in want.fetchall())


@pytest.mark.parametrize("name", ["op6_sharding", "op8_license_scan"])
def test_native_queries_use_no_python(spark, name):
    plan = entry.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Python|Arrow|MapIn", plan)


def test_nearest_recall_on_the_embeddings(spark):
    vectors = spark.read.parquet(f"{SMALL}/embeddings.parquet").toPandas()
    column = next(c for c in vectors.columns if c != "vec_id" and hasattr(vectors[c].iloc[0], "__len__") and not isinstance(vectors[c].iloc[0], str))
    ids = vectors.vec_id.to_numpy()
    x = np.array(vectors[column].tolist(), dtype=np.float64)
    norm = np.linalg.norm(x, axis=1)
    ok = np.isfinite(x).all(axis=1) & (norm > 0)
    ids, x = ids[ok], x[ok] / norm[ok, None]
    got = defaultdict(set)
    for r in entry.queries()["op9_nearest"](spark, SMALL).collect():
        got[r.query_id].add(r.vec_id)
    hits = total = 0
    for i in np.flatnonzero(ids % 50 == 0):
        c = x @ x[i]
        c[i] = -2
        best = set(ids[np.lexsort((ids, -c))[:5]].tolist())
        hits += len(best & got[ids[i]])
        total += len(best)
    assert hits >= 0.9 * total > 0


@pytest.fixture(scope="module")
def clashing(spark):
    """The small tables with columns named as operators might name their own, repeated rows and nulls."""
    folder = work_path(spark, "t-pipeline")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = docs.limit(3).select(
        F.when(F.col("doc_id") < 0, F.col("doc_id")).alias("doc_id"), F.lit(None).cast("string").alias("text"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in docs.schema.fields if f.name not in ("doc_id", "text")],
    )
    docs = docs.unionByName(docs.limit(5)).unionByName(odd)
    for name, value in (("__row", 1), ("__text", "t"), ("__runs", 2), ("_id", 3), ("_row", 4), ("_hash", 5), ("kept", 6), ("size", "s")):
        docs = docs.withColumn(name, F.lit(value))
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SMALL}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_pipeline_equals_brute_force(spark, clashing):
    docs = spark.read.parquet(f"{clashing}/documents.parquet")
    names = docs.columns
    stages, at = [], docs
    for name, f in corpus_pipeline.STAGES[:-1]:
        at = corpus_pipeline.stage(f(spark, at, clashing), "t-" + name.split()[0])
        assert at.columns == names, name
        stages.append(at)
    good, exact, near, mixed = ([r.asDict() for r in s.collect()] for s in stages)
    before = [r.asDict() for r in docs.collect()]

    def key(r):
        return tuple(str(r[c]) for c in names)

    # quality: the rows the classifier accepts
    model = quality.train(docs, spark.read.parquet(f"{clashing}/labels.parquet"))
    accepted = Counter((r.doc_id, r.predicted) for r in quality.score(docs, model).collect())
    assert Counter(r["doc_id"] for r in good) == Counter({i: n for (i, p), n in accepted.items() if p})
    assert not Counter(map(key, good)) - Counter(map(key, before)) and 0 < len(good) < len(before)
    # exact: of equal texts the largest id
    largest = {}
    for r in good:
        t, i = lower(r["text"]), r["doc_id"]
        if t not in largest or (i is not None and (largest[t] is None or i > largest[t])):
            largest[t] = i
    assert Counter((lower(r["text"]), r["doc_id"]) for r in exact) == Counter(largest.items())
    # near: one document of each group of five-word shingles at 0.8, the smallest id
    sets = []
    for r in exact:
        w = SPACED.findall(lower(r["text"]))
        sets.append({tuple(w[a : a + 5]) for a in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and min(len(x), len(y)) * 5 >= 4 * max(len(x), len(y)) and 5 * len(x & y) >= 4 * len(x | y):
                label = [label[b] if v == label[a] else v for v in label]
    groups = defaultdict(list)
    for r, g in zip(exact, label):
        groups[g].append(r["doc_id"])
    want = Counter(min([i for i in g if i is not None], default=None) for g in groups.values())
    assert Counter(r["doc_id"] for r in near) == want and len(near) < len(exact)
    # mix: as many words of each document as the mix takes, all of them the document's
    taken = {r.doc_id: r.taken for r in mixing.Mix(stages[2]).per_document().collect()}
    words = Counter()
    texts = {r["doc_id"]: SPACED.findall(r["text"] or "") for r in near}
    for r in mixed:
        found = SPACED.findall(r["text"])
        words[r["doc_id"]] += len(found)
        assert not Counter(found) - Counter(texts[r["doc_id"]]) and r["n_chars"] == len(r["text"])
    assert words == Counter({i: n for i, n in taken.items() if n})
    # BPE: the library's ids, and the text they decode to
    lib = Tokenizer.from_file(bpe.default_path())
    final = corpus_pipeline.STAGES[-1][1](spark, stages[3], clashing).collect()
    want = Counter((r["doc_id"], tuple(lib.encode(r["text"], add_special_tokens=False).ids), r["text"]) for r in mixed)
    assert Counter((r.doc_id, tuple(r.ids), r.text) for r in final) == want
    # run() is these stages
    assert Counter((r.doc_id, tuple(r.ids), r.text) for r in corpus_pipeline.run(spark, clashing).collect()) == want


def test_pipeline_of_no_rows(spark):
    folder = work_path(spark, "t-pipeline-empty")
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
