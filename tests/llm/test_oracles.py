"""Text-corpus queries against their SQL, on a whole small table and with small parameters."""

import duckdb
import pytest

from cairn.llm import exact_dedup, line_dedup, mixing, sharding
from cairn.llm.oracles import EXACT, LINES, MIXING, ORACLES, shard_sql
from cairn.llm.queries import QUERIES
from tests.conftest import SF_SMALL

TABLES = ["documents", "conversations", "labels", "benchmark"]


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(repr(round(r[i], 6) if isinstance(r[i], float) else r[i]) for i in order) for r in data)


def same(df, con, sql):
    cur = con.execute(sql)
    assert sorted(df.columns) == sorted(d[0] for d in cur.description)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows([d[0] for d in cur.description], cur.fetchall())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    same(QUERIES[name](spark, SF_SMALL), con, ORACLES[name])


def messy(spark):
    """Nulls, empty, blank and repeated texts, ties, a long text, and clashing column names."""
    long = "\n".join(f"Line {i % 700} of a very long text, repeated {i % 7}" for i in range(4000))
    texts = ["", "  \t\n ", "Same text here, long enough to count\nother", "same TEXT here, long enough to count\nother",
             "same text here, long enough to count", long, long.upper(), "ÉCOLE école K k", "x" * 9000, "x" * 9000,
             " Same Text here, LONG enough to count\t\nlast", "a b c"]
    data = [(i, t, "en" if i % 2 else None, None if i % 4 == 0 else f"s{i % 3}") for i, t in enumerate(texts)]
    data += [(100, None, None, None)]
    schema = "doc_id long, text string, lang string, source string"
    df = spark.createDataFrame(data, schema)
    for c in ("size", "h", "row_id", "name", "kept", "shard", "score", "weight", "n", "pos", "cell", "key", "bytes", "fp"):
        df = df.selectExpr("*", f"'clash' AS {c}")
    return df


@pytest.fixture(scope="module")
def messy_con(spark):
    c = duckdb.connect()
    table = messy(spark).select("doc_id", "text", "lang", "source").toArrow()
    c.register("documents", table)
    return c


@pytest.mark.parametrize("block,weak", [(8192, False), (64, False), (64, True)])
def test_exact_dedup_small_blocks_and_colliding_hashes(spark, messy_con, block, weak):
    from pyspark.sql import functions as F
    h = (lambda c: F.pmod(F.xxhash64(c), F.lit(5))) if weak else F.xxhash64
    same(exact_dedup.exact_duplicates(messy(spark), block, h), messy_con, EXACT)


def test_line_dedup_messy(spark, messy_con):
    from pyspark.sql import functions as F
    out = line_dedup.deduplicate_lines(messy(spark))
    same(out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")),
         messy_con, LINES)


def test_mixing_messy(spark, messy_con):
    slim = mixing.sizes(messy(spark))
    plan = mixing.plan_mix(slim, mixing.ranked_weights(slim, (5, 2, 1)))
    out = mixing.taken_words(slim, plan)
    same(out, messy_con, MIXING)
    got = out.selectExpr("sum(taken) AS t", "sum(size) AS s", "max(taken - 3 * size) AS over").first()
    assert abs(got.t - got.s) <= 4 and got.over <= 0


@pytest.mark.parametrize("limit", [500, 20_000, 300_000])
def test_sharding_limits(spark, con, limit):
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = sharding.shard(docs, limit).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
                                             "shard", "shard_depth", "shard_bytes")
    same(out, con, shard_sql(limit))


def test_sharding_repeated_rows_overflow(spark):
    from pyspark.sql import functions as F
    data = [(7, "y" * 100)] * 50 + [(None, "z" * 100)] * 30 + [(i, "w" * 10) for i in range(40)] + [(99, None), (98, "q" * 5000)]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    out = sharding.shard(docs, 1000).cache()
    assert out.count() == len(data)
    per = out.groupBy("shard").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("b"), F.count("*").alias("n"),
                                   F.max("shard_bytes").alias("told")).collect()
    assert all(r.b <= 1000 or r.n == 1 for r in per) and all(r.b == r.told for r in per)


def test_sharding_messy_keeps_columns(spark):
    out = sharding.shard(messy(spark), 10_000)
    assert out.count() == messy(spark).count()
    assert out.columns == [c for c in messy(spark).columns if c != "shard"] + ["shard", "shard_depth", "shard_bytes"]


def test_empty_tables(spark):
    from cairn.llm import chat, context_mixing, decontamination, simhash, token_counts, toxicity
    import public_tokenizers
    none = messy(spark).limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    slim = mixing.sizes(none)
    plan = mixing.plan_mix(slim, mixing.ranked_weights(slim, (5, 2, 1)))
    for df in (exact_dedup.exact_duplicates(none), line_dedup.deduplicate_lines(none), sharding.shard(none),
               mixing.taken_words(slim, plan), mixing.mixed(none, plan), simhash.near_duplicates(none),
               simhash.one_per_group(none), toxicity.toxicity(none, labels), toxicity.without_toxic(none, labels),
               decontamination.leaks(none, bench), decontamination.without_leaks(none, bench), context_mixing.score(none),
               token_counts.count_tokens(none, public_tokenizers.path("byte_bpe_50k.json")),
               chat.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))):
        assert df.count() == 0
    docs = messy(spark)
    assert decontamination.leaks(docs, bench).count() == 0
    assert decontamination.without_leaks(docs, bench).count() == docs.count()
    out = toxicity.toxicity(docs, labels).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 and r.predicted == 0 for r in out)
