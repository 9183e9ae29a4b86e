"""WARC archives written and read by Spark, with the record boundaries proven by a chain of offsets.

Writing: a record per row as one text value; the terminator of a WARC record is the line separator of Spark's
text writer, so files are written and committed by Spark itself. Of rows with equal payloads the one with the
largest key is a `response`, the others are `revisit` records without a payload that refer to it.

Reading: the text reader splits files at the magic `WARC/1.`, wherever it stands, also inside payloads. Tasks
turn every such place into a candidate: its offset and the offset its header says the next record has. Inside
a block a candidate's exit is the first place its chain reaches beyond the block; over the blocks, exits are
joined by pointer jumping from the start of the file (round k doubles the jumps of round k-1). Only candidates
on that chain are records. A payload that holds the magic spans several pieces; only for those are texts read
again and put together. A url that holds the magic is written with its slash percent-encoded, so that headers
never hold it, and read back as it was given.

Defined results: a null payload is empty; rows with a null key refer to nothing and are called by no one unless
all rows of a payload have null keys, which then are all responses; rows that tie on payload and key are all
responses. A record whose header can't be parsed ends its chain; what follows it in that file is not read.
Empty tables give no archive rows. Columns other than the named ones are not written.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mentidero.llm.common import field, stage
from mentidero.sources.lake import empty

# --- fixed values: the format ---
MAGIC, TERMINATOR = "WARC/1.", "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
# --- end of fixed values ---
BITMAP = 8 * 4096  # bits that one value of bitmap_construct_agg holds
SLOTS = 1024 * BITMAP  # 4 MB at most


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: 40 hex digits are four times 8 base-32 digits."""
    digits = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def _without_magic(url: Column) -> Column:
    """The url with the magic's slash as %2F; places that read so already get another 25, so none is ambiguous."""
    return F.regexp_replace(F.regexp_replace(url, r"WARC%(?=(?:25)*2F1\.)", "WARC%25"), r"WARC/1\.", "WARC%2F1.")


def _with_magic(head: Column) -> Column:
    """A head whose url is again the one that was given to `_without_magic`."""
    line = F.regexp_extract(head, r"(?mi)^WARC-Target-URI:[^\r\n]*", 0)
    given = F.regexp_replace(F.regexp_replace(line, r"WARC%2F1\.", "WARC/1."), r"WARC%25(?=(?:25)*2F1\.)", "WARC%")
    return F.when(line.contains("WARC%"), F.replace(head, line, given)).otherwise(head)


def _mark_repeated(rows: DataFrame, winners: DataFrame) -> DataFrame:
    """Rows with `marked`: true for every digest in `winners`, false for nearly all others.

    The bitmap has SLOTS bits whatever the input, so it may be broadcast. Rows that aren't marked need no
    shuffle; the fuller the bitmap, the more rows are marked in vain and take the join, with the same result.
    """
    numbered = lambda df: df.withColumn("slot", F.pmod(F.xxhash64("digest"), F.lit(SLOTS)))
    part, bit = F.floor(F.col("slot") / BITMAP), F.col("slot") % BITMAP
    bitmap = numbered(winners).groupBy(part.alias("part")).agg(F.bitmap_construct_agg(bit).alias("bits"))
    found = numbered(rows).withColumn("part", part).join(F.broadcast(bitmap), "part", "left")
    byte = F.conv(F.hex(F.expr(f"substring(bits, CAST((slot % {BITMAP}) div 8 + 1 AS INT), 1)")), 16, 10).cast("int")
    is_set = F.expr("shiftleft(1, CAST(slot % 8 AS INT))").bitwiseAND(byte) != 0
    return found.withColumn("marked", F.coalesce(is_set, F.lit(False))).drop("slot", "part", "bits")


def write_archives(df: DataFrame, path: str, key: str, payload: str, url: str) -> None:
    rows = df.select(
        field(df, key, "bigint").alias("key"),
        F.coalesce(field(df, payload, "string").cast("binary"), F.lit(b"")).alias("payload"),
        _without_magic(F.regexp_replace(field(df, url, "string"), r"[\r\n]", "")).alias("url"),
    )
    rows = rows.withColumn("digest", base32_sha1(F.col("payload")))
    # Winners per payload combine inside each task first; only payloads that occur again are kept.
    several = rows.groupBy("digest").agg(F.max("key").alias("winner"), F.count("*").alias("n")).where("n > 1")
    winners = stage(several.select("digest", "winner"), "warc-winners")
    marked = _mark_repeated(rows, winners)
    alone = marked.where(~F.col("marked")).withColumn("winner", F.col("key")).withColumn("response", F.lit(True))
    # A payload without a winner here was marked by chance: it occurs once. A hot payload's rows are split by the join.
    met = winners.withColumn("repeated", F.lit(True))
    own = F.col("repeated").isNull() | F.col("key").eqNullSafe(F.col("winner"))
    judged = marked.where("marked").join(met, "digest", "left").withColumn("response", own).drop("repeated").unionByName(alone)
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))
    record_id = lambda k: F.concat(F.lit("<urn:page:"), F.coalesce(k.cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("payload").cast("string"), F.lit("\r\n\r\n"),
    )
    body = F.when(F.col("response"), F.concat(http, F.col("payload").cast("string"))).otherwise(F.lit(""))
    revisits = ~F.col("response")
    record = F.concat(
        F.lit(MAGIC + "1\r\n"),
        line("WARC-Type", F.when(F.col("response"), "response").otherwise("revisit")),
        line("WARC-Record-ID", record_id(F.col("key"))),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("WARC-Profile", F.when(revisits, REVISIT_PROFILE)),
        line("WARC-Refers-To", F.when(revisits, record_id(F.col("winner")))),
        line("X-Payload-Length", F.octet_length("payload").cast("string")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        line("Content-Length", F.octet_length("body").cast("string")),
        F.lit("\r\n"), F.col("body"),
    )
    judged.withColumn("body", body).select(record.alias("value")).write.option("lineSep", TERMINATOR).text(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The text between magics, in reading order: file, block (where its split starts), place, value."""
    return (
        spark.read.option("lineSep", MAGIC).text(path)
        .select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("place"), F.col("value").cast("binary").alias("value"),
        )
    )


def _header(name: str) -> Column:
    return F.regexp_extract("head", rf"(?mi)^{name}:[ \t]*(.*?)[ \t]*\r?$", 1)


def _candidates(pieces: DataFrame) -> DataFrame:
    """One narrow row per piece: its bytes, what its header says, and its payload's digest if it is whole.

    A piece's text begins after the magic, with the version digit.
    """
    head = F.substring_index(F.col("value").cast("string"), TERMINATOR, 1)
    cut = pieces.select("*", F.octet_length("value").cast("bigint").alias("bytes"), F.when(F.col("value").cast("string").rlike(r"^[01]\r\n"), head).alias("head"))
    cut = cut.withColumn("head_bytes", F.octet_length("head") + len(TERMINATOR))
    cut = cut.withColumn("length", F.expr("try_cast(regexp_extract(head, '(?mi)^Content-Length:[ \\\\t]*([0-9]+)[ \\\\t]*\\\\r?$', 1) AS BIGINT)"))
    whole = F.when(F.col("head_bytes") + F.col("length") <= F.col("bytes"), F.expr("substring(value, CAST(head_bytes + 1 AS INT), CAST(length AS INT))"))
    return cut.select(
        "file", "block", "place", "bytes", "head", (F.col("head_bytes") + F.col("length") + len(MAGIC) + len(TERMINATOR)).alias("span"),
        (F.col("head_bytes") <= F.col("bytes")).alias("ended"), *_payload_columns(whole),
    )


def _payload_columns(block: Column) -> list[Column]:
    """Length and digest of what a record's block carries: behind the HTTP header, where there is one."""
    text = block.cast("string")
    http = F.octet_length(F.substring_index(text, TERMINATOR, 1)) + len(TERMINATOR)
    is_http = F.substring(text, 1, 5) == "HTTP/"
    start = F.when(is_http & (http <= F.octet_length(block)), http).otherwise(F.lit(0))
    payload = F.substring(block, start + 1, F.octet_length(block) - start)
    return [(F.octet_length(block) - start).cast("bigint").alias("payload_bytes"), base32_sha1(payload).alias("digest")]


def _with_offsets(pieces: DataFrame) -> DataFrame:
    """Absolute offsets of the magics: bytes of the file's earlier blocks, plus those before it in its block.

    A piece belongs to one block; the piece before the first magic starts the file and has offset -len(magic).
    """
    size = F.col("bytes") + len(MAGIC)
    totals = pieces.groupBy("file", "block").agg(F.sum(size).alias("total"))
    earlier = "sum(total) OVER (PARTITION BY file ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    bases = totals.select("file", "block", "total", F.coalesce(F.expr(earlier), F.lit(0)).alias("base"))
    return pieces.join(bases, ["file", "block"])


CHAIN = "file string, block bigint, offset bigint, exit bigint, last bigint"


def _exits(group: pd.DataFrame) -> pd.DataFrame:
    """Of one block: where each candidate's chain leaves the block, and the last record it meets inside."""
    group = group.sort_values("place", kind="stable")
    end = int(group["base"].iloc[0] + group["total"].iloc[0]) - len(MAGIC)
    offsets = (group["base"] + (group["bytes"] + len(MAGIC)).cumsum().shift(fill_value=0)).to_numpy(np.int64) - len(MAGIC)
    following = offsets + group["span"].fillna(0).to_numpy(np.int64)
    usable = (group["ended"].eq(True) & group["span"].notna()).to_numpy(bool) & (offsets >= 0)
    at = np.searchsorted(offsets, following)
    exits, last = np.full(len(group), -1, dtype=np.int64), offsets.copy()
    for i in range(len(group) - 1, -1, -1):
        if not usable[i]:
            continue
        if following[i] >= end:
            exits[i] = following[i]
        elif at[i] < len(offsets) and offsets[at[i]] == following[i]:
            exits[i], last[i] = exits[at[i]], last[at[i]]
    return pd.DataFrame({"file": group["file"], "block": group["block"], "offset": offsets, "exit": exits, "last": last})[usable]


def _entries(chains: DataFrame, blocks: int) -> DataFrame:
    """The candidates at which the true chain enters a block: pointer jumping from offset 0 of each file."""
    jumps = chains.select("file", "offset", F.col("exit").alias("to"))
    reached = chains.where("offset = 0").select("file", "offset")
    rounds = max(1, (blocks - 1).bit_length() + 1) if blocks > 1 else 0
    for _ in range(rounds):
        hop = reached.join(jumps, ["file", "offset"]).select("file", F.col("to").alias("offset"))
        reached = stage(reached.unionByName(hop).distinct(), "warc-reached")
        again = jumps.select("file", F.col("offset").alias("to"), F.col("to").alias("far"))
        jumps = stage(jumps.join(again, ["file", "to"]).select("file", "offset", F.col("far").alias("to")), "warc-jumps")
    return chains.join(reached, ["file", "offset"], "left_semi")


WALK = "file string, block bigint, place bigint, offset bigint, owner bigint, is_record boolean"


def _walk(group: pd.DataFrame) -> pd.DataFrame:
    """Of one block: which candidates lie on the chain, and the record each piece belongs to."""
    group = group.sort_values("place", kind="stable")
    offsets = (group["base"] + (group["bytes"] + len(MAGIC)).cumsum().shift(fill_value=0)).to_numpy(np.int64) - len(MAGIC)
    spans, entry = group["span"].fillna(0).to_numpy(np.int64), group["entry"].iloc[0]
    usable = (group["ended"].eq(True) & group["span"].notna()).to_numpy(bool)
    on_chain = np.zeros(len(group), dtype=bool)
    place = np.searchsorted(offsets, entry) if pd.notna(entry) else len(offsets)
    while place < len(offsets) and usable[place]:
        on_chain[place] = True
        following = offsets[place] + spans[place]
        place = np.searchsorted(offsets, following)
        if place < len(offsets) and offsets[place] != following:
            break
    carried = group["carried"].iloc[0]
    owner = pd.Series(np.where(on_chain, offsets, np.nan)).ffill().fillna(carried if pd.notna(carried) else -1).to_numpy(np.int64)
    return pd.DataFrame({"file": group["file"], "block": group["block"], "place": group["place"], "offset": offsets, "owner": owner, "is_record": on_chain})


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record on the chain: file, offset, head, payload_bytes and digest of what its block carries."""
    candidates = stage(_candidates(_pieces(spark, path)), "warc-candidates")
    if not candidates.limit(1).count():
        return empty(spark, candidates.select("file", F.lit(0).cast("bigint").alias("offset"), "head", "payload_bytes", "digest").schema)
    placed = _with_offsets(candidates.select("file", "block", "place", "bytes", "span", "ended"))
    chains = stage(placed.groupBy("file", "block").applyInPandas(_exits, CHAIN), "warc-chains")
    per_file = candidates.select("file", "block").distinct().groupBy("file").count()
    entered = _entries(chains, per_file.agg(F.max("count")).first()[0])
    # What a block's first pieces belong to: the last record of the nearest earlier block that was entered.
    blocks = candidates.select("file", "block").distinct().join(
        entered.select("file", "block", F.col("offset").alias("entry"), "last"), ["file", "block"], "left"
    )
    before = "last(last, true) OVER (PARTITION BY file ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    blocks = blocks.select("file", "block", "entry", F.expr(before).alias("carried"))
    walked = stage(placed.join(blocks, ["file", "block"]).groupBy("file", "block").applyInPandas(_walk, WALK), "warc-records")
    records = candidates.join(walked.where("is_record"), ["file", "block", "place"])
    split = stage(records.where("digest IS NULL").select("file", "offset", "head", "span"), "warc-split")
    whole = records.where("digest IS NOT NULL").select("file", "offset", "head", "payload_bytes", "digest")
    if split.limit(1).count():
        whole = whole.unionByName(_put_together(spark, path, split))
    return whole.withColumn("head", _with_magic(F.col("head")))


def _put_together(spark: SparkSession, path: str, split: DataFrame) -> DataFrame:
    """Records whose payload holds the magic: their files are read again, and the pieces joined in order."""
    again = _pieces(spark, path).join(split.select("file").distinct(), "file", "left_semi")
    sized = again.withColumn("bytes", F.octet_length("value").cast("bigint"))
    within = "sum(bytes + {0}) OVER (PARTITION BY file, block ORDER BY place) - bytes - {0}".format(len(MAGIC))
    placed = _with_offsets(sized).select(
        "file", (F.col("base") + F.expr(within) - len(MAGIC)).alias("at"), "value"
    )
    ends = split.withColumn("stop", F.col("offset") + F.col("span"))
    inside = placed.join(ends, "file").where("at >= offset AND at < stop")
    parts = F.sort_array(F.collect_list(F.struct("at", "value")))
    text = F.array_join(F.transform(parts, lambda p: p["value"].cast("string")), MAGIC)
    joined = inside.groupBy("file", "offset", "head", "span").agg(text.cast("binary").alias("bytes"))
    skip = F.octet_length("head") + len(TERMINATOR)
    block = F.expr(
        f"substring(bytes, CAST(octet_length(head) + {len(TERMINATOR) + 1} AS INT), "
        f"CAST(span - octet_length(head) - {2 * len(TERMINATOR) + len(MAGIC)} AS INT))"
    )
    return joined.where(F.octet_length("bytes") >= skip).select("file", "offset", "head", *_payload_columns(block))


def page_records(records: DataFrame) -> DataFrame:
    """The agreed fields of records: key, type, reference, and length and digest of the full payload."""
    kind = _header("WARC-Type")
    number = lambda name: F.expr(f"try_cast(regexp_extract({name}, '([0-9-]+)>$', 1) AS BIGINT)")
    named = records.select(
        "*", kind.alias("record_type"), _header("WARC-Record-ID").alias("id"), _header("WARC-Refers-To").alias("refers"),
        _header("X-Payload-Length").alias("stated_bytes"), _header("WARC-Payload-Digest").alias("stated_digest"),
    )
    own = F.col("record_type") == "response"
    return named.select(
        number("id").alias("key"),
        F.when(own, F.col("payload_bytes")).otherwise(F.col("stated_bytes").cast("bigint")).alias("payload_bytes"),
        F.when(own, F.col("digest")).otherwise(F.regexp_replace("stated_digest", "^sha1:", "")).alias("payload_digest"),
        "record_type", F.when(~own, number("refers")).alias("refers_to"),
    )
