"""The pipeline's stages on the smallest tables, each against what its own input allows."""

import collections
import re

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The result of each stage, written and read again."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_stages_keep_columns(stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns


def test_toxicity_stage(stages):
    kept = {r.doc_id for r in stages[1].collect()}
    labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{SF}/labels.parquet'").fetchall())
    clean, bad = [d for d, t in labels.items() if not t], [d for d, t in labels.items() if t]
    assert sum(d in kept for d in clean) >= 0.97 * len(clean) and sum(d in kept for d in bad) <= 0.5 * len(bad)


def test_exact_stage(stages):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    top = {}
    for r in stages[1].collect():
        t = (r.text or "").translate(low)
        top[t] = max(r.doc_id, top.get(t, -1))
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(top.values())


def test_near_stage(stages):
    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}

    rows = {r.doc_id: shingles(r.text or "") for r in stages[2].collect()}
    kept = {r.doc_id for r in stages[3].collect()}
    similar = [(a, b) for a in rows for b in rows if a < b and len(rows[a] & rows[b]) >= 0.8 * len(rows[a] | rows[b])]
    assert all(not (a in kept and b in kept) for a, b in similar)
    assert set(rows) - kept <= {b for _, b in similar}


def test_mix_and_packing(stages):
    once = {r.doc_id: r.text for r in stages[3].collect()}
    copies = collections.Counter(r.doc_id for r in stages[4].collect())
    assert set(copies) <= set(once) and max(copies.values()) <= 3
    words = lambda t: len((t or "").split())
    assert abs(sum(words(once[d]) * n for d, n in copies.items()) - sum(map(words, once.values()))) <= 0.05 * sum(map(words, once.values())) + 2000
    pieces = stages[5].collect()
    assert collections.Counter(r.doc_id for r in pieces if r.start == 0) == copies


def test_run_is_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == stages[-1].columns and got.count() == stages[-1].count()


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and {int(n[2:].split("_")[0]) for n in names if re.match(r"op\d+_", n)} == set(range(1, 11))
    assert set(__spark_entry__.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", ["op4_warc", "op6_exact_dedup", "op7_licences", "op8_topk", "op9_secrets"])
def test_matches_sql(spark, tmp_path, name):
    c = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = __spark_entry__.queries()[name](spark, SF)
    df.write.parquet(str(tmp_path / "out"))
    columns = ", ".join(sorted(df.columns))
    ours, theirs = f"SELECT {columns} FROM '{tmp_path}/out/*.parquet'", f"SELECT {columns} FROM ({__spark_entry__.oracle_sql()[name]})"
    assert c.sql(f"({ours}) EXCEPT ALL ({theirs})").fetchall() == [] == c.sql(f"({theirs}) EXCEPT ALL ({ours})").fetchall()
