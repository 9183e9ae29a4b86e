from fixtures import comment, post, write_lines
from pyspark.sql import functions as F

from mentidero.operators.bronze import to_bronze
from mentidero.operators.silver import dedupe_latest
from mentidero.plans.medallion import read_bronze
from mentidero.schemas import bronze_schema, store_schema
from mentidero.sources.ndjson import read_raw
from mentidero.sources.store import KeyedTable
from mentidero.streaming import incremental as inc


def values(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_bronze_stream_equals_batch_and_picks_up_new_files_once(spark, tmp_path):
    raw, out, ck = f"{tmp_path}/raw", f"{tmp_path}/bronze", f"{tmp_path}/ck"
    write_lines(f"{raw}/a.ndjson", [post(i, "Art") for i in range(5)])
    for extra in (None, "b", None):
        if extra:
            write_lines(f"{raw}/{extra}.ndjson", [post(9, "Maps", edited=1.0, created_utc=None)])
        inc.stream_bronze(spark, raw, "posts", f"{out}/posts", ck, "b1").awaitTermination()
    names = bronze_schema("posts").fieldNames()
    streamed = read_bronze(spark, out, "posts")
    batch = to_bronze(read_raw(spark, raw, "posts"), "posts")
    assert values(streamed.select(*names)) == values(batch.select(*names)) and streamed.count() == 6


def test_upsert_stream_replayed_is_the_same(spark, tmp_path):
    raw = f"{tmp_path}/raw"
    write_lines(f"{raw}/a.ndjson", [comment(i, "p1", f"text {i}") for i in range(20)])
    schema = store_schema("comments")
    table = KeyedTable(spark, f"{tmp_path}/t", schema, "comment_id", buckets=4)

    def run(checkpoint):
        rows = to_bronze(inc.raw_stream(spark, raw, "comments"), "comments")
        inc.stream_upsert(rows, table, f"{tmp_path}/{checkpoint}", ["created_utc"]).awaitTermination()

    run("ck1")
    first = values(table.read())
    run("ck2")  # a lost checkpoint: everything arrives again
    assert values(table.read()) == first and len(first) == 20
    write_lines(f"{raw}/b.ndjson", [comment(3, "p1", "changed"), comment(50, "p1", "new")])
    run("ck1")
    got = {r["comment_id"]: r["body"] for r in table.read().collect()}
    assert len(got) == 21 and got["c3"] == "changed" and got["c4"] == "text 4"


def test_dedupe_stream_over_overlapping_files(spark, tmp_path):
    raw = f"{tmp_path}/raw"
    write_lines(f"{raw}/a.ndjson", [comment(i, "p", "x") for i in range(30)])

    def run(checkpoint="ck"):
        rows = to_bronze(inc.raw_stream(spark, raw, "comments"), "comments")
        inc.stream_dedupe(rows, "comment_id", f"{tmp_path}/out", f"{tmp_path}/{checkpoint}", "1 hour").awaitTermination()
        return inc.read_deduped(spark, f"{tmp_path}/out", bronze_schema("comments"))

    assert run().count() == 30
    # Repeats, rows years older than those seen, and a row without a time.
    write_lines(f"{raw}/b.ndjson", [comment(i, "p", "x") for i in range(15, 45)] + [
        comment(90, "p", "old", created_utc=1.0), comment(91, "p", "timeless", created_utc=None)])
    out = run()
    batch = dedupe_latest(to_bronze(read_raw(spark, raw, "comments"), "comments"), "comment_id")
    assert values(out) == values(batch.select(*out.columns)) and out.count() == 47
    # A stream without state of them: all keys are older than its span and known from the table alone.
    write_lines(f"{raw}/c.ndjson", [comment(200, "p", "new")])
    assert run("other").count() == 48


def test_score_stream_equals_batch(spark, tmp_path):
    raw = f"{tmp_path}/raw"
    write_lines(f"{raw}/a.ndjson", [comment(i, "p", "x" * i) for i in range(10)])

    def score(df):
        return df.withColumn("p", F.length("body") / 10)

    rows = to_bronze(inc.raw_stream(spark, raw, "comments"), "comments").select("comment_id", "body")
    inc.stream_score(rows, score, f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    batch = score(to_bronze(read_raw(spark, raw, "comments"), "comments").select("comment_id", "body"))
    assert values(spark.read.parquet(f"{tmp_path}/out")) == values(batch)


def test_table_stream_reads_a_file_and_a_folder_of_files(spark, tmp_path):
    rows = spark.range(40).select(F.col("id").alias("vec_id"), (F.col("id") % 2).alias("label"))
    rows.repartition(4).write.parquet(f"{tmp_path}/in/many.parquet")
    rows.coalesce(1).write.parquet(f"{tmp_path}/one")
    next((tmp_path / "one").glob("part-*")).rename(tmp_path / "in" / "one.parquet")
    for name in ("one", "many"):
        stream = inc.table_stream(spark, f"{tmp_path}/in/{name}.parquet", rows.schema)
        inc.stream_score(stream, lambda df: df, f"{tmp_path}/{name}-out", f"{tmp_path}/{name}-ck").awaitTermination()
        assert values(inc.read_scored(spark, f"{tmp_path}/{name}-out", rows.schema)) == values(rows)


def test_streams_over_tables_of_several_files(spark, tmp_path):
    """A grown table is a folder of files; its stream has the rows of its batch read."""
    from mentidero.plans import queries

    vectors = spark.createDataFrame([(i, [i / 10, -0.5], i % 3) for i in range(12)], "vec_id long, embedding array<float>, label int")
    vectors.repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.stream_score(spark, str(tmp_path))
    assert values(got) == values(queries.score_mlp(spark, str(tmp_path)).select("vec_id", "label", "score")) and got.count() == 12
    assert inc.read_scored(spark, f"{tmp_path}/never", vectors.schema).count() == 0
