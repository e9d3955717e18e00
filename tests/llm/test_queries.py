"""The registered queries against DuckDB, and the pipeline on planted cases."""

import random

import duckdb
import pytest

import corpus_pipeline
from tierwise.llm.common import table

SMOKE_DIR = "/root/testdata/sf0.001"


def test_registry():
    names = set(corpus_pipeline.QUERIES)
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}
    assert set(corpus_pipeline.SQL) <= names
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality", "near_duplicates", "decontamination", "personal_data", "encoding"]


@pytest.mark.parametrize("key", sorted(corpus_pipeline.SQL))
def test_query_matches_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE_DIR}/{t}.parquet')")
    df = corpus_pipeline.QUERIES[key](spark, SMOKE_DIR)
    cols = sorted(df.columns)
    res = con.execute(corpus_pipeline.SQL[key])
    at = [[c[0] for c in res.description].index(c) for c in cols]
    assert sorted(c[0] for c in res.description) == cols
    assert sorted(map(tuple, df.select(cols).collect()), key=repr) == sorted(
        [tuple(r[i] for i in at) for r in res.fetchall()], key=repr)


def test_pipeline_on_planted_cases(spark, tmp_path):
    """Junk goes, one of each group stays, benchmark texts go, personal data is replaced,
    and every clean document arrives whole, as ids that decode to it."""
    import public_tokenizers

    from tierwise.llm.pieces import PieceCodec

    r = random.Random(3)
    words = ["".join(r.choice(["ka", "lo", "mi", "ne", "tu", "ra"]) for _ in range(r.randint(1, 3))) for _ in range(80)]

    def prose(n):
        return " ".join(r.choice(words) for _ in range(n)).capitalize() + "."

    clean = {i: prose(r.randint(40, 200)) for i in range(120)}
    junk = {1000 + i: " ".join(w + "***" for w in prose(60).split()) for i in range(60)}
    items = [(i, prose(30)) for i in range(5)]
    copies = {2000 + i: clean[i] for i in range(10)}
    leaks = {3000 + i: prose(40) + " " + t + " " + prose(40) for i, t in items}
    private = {4000: prose(50) + " a.b@example.com " + prose(50)}
    docs = {**clean, **junk, **copies, **leaks, **private}
    rows = [(i, t, "en", "src0", len(t)) for i, t in docs.items()] + [(5000, "", "en", None, 0), (5001, None, None, None, None)]
    write = lambda data, ddl, name: spark.createDataFrame(data, ddl).write.parquet(f"{tmp_path}/{name}.parquet")
    write(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint", "documents")
    write([(i, int(i < 1000)) for i in [*clean, *junk]], "doc_id bigint, quality int", "labels")
    write(items, "item_id bigint, text string", "benchmark")
    kept, columns = table(spark, str(tmp_path), "documents"), None
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, kept, str(tmp_path)).write.parquet(f"{tmp_path}/stage{k}")
        columns = columns or kept.columns
        kept = spark.read.parquet(f"{tmp_path}/stage{k}")
        assert kept.columns == columns
    out = {x["doc_id"]: x for x in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert {i for i in out if i < 1000} == set(clean) and not set(out) & {*junk, *copies, *leaks}
    codec = PieceCodec(public_tokenizers.path("piece_bpe_32k.model"))
    assert all(codec.decode(out[i]["ids"]) == t for i, t in clean.items())
    assert codec.decode(out[4000]["ids"]) == private[4000].replace("a.b@example.com", "[EMAIL]")
    assert len(set(out) & {5000, 5001}) <= 1  # no words: one fingerprint
