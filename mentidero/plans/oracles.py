"""The registered queries as SQL over the driver tables, written from the definition of each result."""

from __future__ import annotations

from mentidero.operators.training import draw_trials

# --- the stand-ins of `standins`, as common table expressions ---

EPOCH = "epoch_us(ts) / 1000000.0"

POSTS = f"""posts AS (
  SELECT CAST(event_id AS VARCHAR) AS post_id,
         ' ' || event_type || chr(9) AS subreddit,
         'user' || user_id AS author,
         event_type || ' by ' || user_id AS title,
         props AS selftext,
         CAST(NULL AS VARCHAR) AS url,
         CAST(NULL AS VARCHAR) AS permalink,
         CAST(trunc(value) AS BIGINT) AS score,
         user_id AS num_comments,
         CASE WHEN value >= 200 THEN TRUE WHEN value < 1 THEN NULL ELSE FALSE END AS over_18,
         {EPOCH} AS created_utc,
         CAST(NULL AS VARCHAR) AS link_flair_text,
         event_type = 'click' AS is_self,
         CAST(NULL AS BOOLEAN) AS spoiler,
         CAST(NULL AS BOOLEAN) AS locked,
         CAST(NULL AS VARCHAR) AS thumbnail,
         event_id, ts
  FROM events)"""

COMMENTS = """comments AS (
  SELECT CAST(doc_id AS VARCHAR) AS comment_id,
         CAST(n_chars AS VARCHAR) AS post_id,
         CASE WHEN source = 'src5' AND lang = 'de' THEN NULL ELSE source END AS author,
         CASE WHEN source = 'src7' THEN '[deleted]'
              WHEN source = 'src11' AND lang = 'fr' THEN '[removed]'
              WHEN source = 'src13' AND lang = 'de' THEN NULL
              WHEN lang = 'es' THEN text || ' see http://www.' || source || '.example.com/a?b=1 ok? wow!'
              ELSE text END AS body,
         CAST(doc_id * 60 + 1704067200 AS DOUBLE) AS created_utc,
         't1_' || doc_id AS parent_id,
         't3_' || n_chars AS link_id,
         n_chars AS score,
         CASE WHEN lang = 'en' THEN TRUE WHEN lang = 'fr' THEN FALSE END AS is_submitter
  FROM documents)"""

# Python's white space as an RE2 class body.
BLANK = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def words(col: str) -> str:
    return f"CAST(len(list_filter(regexp_split_to_array({col}, '[{BLANK}]+'), lambda x: x <> '')) AS INTEGER)"


def cleaned(col: str) -> str:
    no_urls = f"regexp_replace(lower({col}), 'http[^{BLANK}]+', '', 'g')"
    plain = f"regexp_replace({no_urls}, '[^a-zA-Z0-9?!.,''’ ]', ' ', 'g')"
    return f"trim(regexp_replace({plain}, ' +', ' ', 'g'))"


LIVE = "live AS (SELECT * FROM comments WHERE body IS NOT NULL AND body NOT IN ('[deleted]', '[removed]'))"
TEXTS = "live AS (SELECT * REPLACE (coalesce(body, 'None') AS body) FROM comments WHERE body IS NULL OR body NOT IN ('[deleted]', '[removed]'))"
FEATURES = f"""features AS (
  SELECT *, CAST(length(body) AS INTEGER) AS text_len, {words("body")} AS word_count,
         contains(body, '!') AS has_exclamation, contains(body, '?') AS has_question,
         author IS NOT NULL AS has_author
  FROM live WHERE length(body) > 2)"""
TAILS = """tails AS (
  SELECT quantile_cont(CAST(score AS DOUBLE), 0.01) AS lo, quantile_cont(CAST(score AS DOUBLE), 0.99) AS hi,
         quantile_cont(CAST(text_len AS DOUBLE), 0.99) AS len_hi
  FROM features)"""
CLIPPED = """clipped AS (
  SELECT f.*, greatest(least(CAST(score AS DOUBLE), hi), lo) AS score_clipped,
         least(CAST(text_len AS DOUBLE), len_hi) AS text_len_clipped
  FROM features f, tails)"""
CLEANED = f"""cleaned AS (
  SELECT * FROM (SELECT *, {cleaned("body")} AS clean_text FROM clipped) c WHERE length(clean_text) > 3)"""
WRANGLE = f"WITH {COMMENTS}, {TEXTS}, {FEATURES}, {TAILS}, {CLIPPED}, {CLEANED}"

PREDICTIONS = """predictions AS (
  SELECT CASE l_returnflag WHEN 'A' THEN 'bert_bert-base-multilingual-uncased-sentiment'
                           WHEN 'N' THEN 'mlp_transformer'
                           ELSE 'bert_distilbert-base-uncased-finetuned-sst-2-english' END AS model_key,
         CASE WHEN l_linestatus = 'O' THEN 'val' ELSE 'test' END AS split,
         CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS y,
         CASE WHEN l_extendedprice > 40000 THEN 1 ELSE 0 END AS p
  FROM lineitem)"""


def acc(cond: str = "TRUE") -> str:
    return f"avg(CASE WHEN {cond} THEN CASE WHEN y = p THEN 1.0 ELSE 0.0 END END)"


def f1(cond: str = "TRUE") -> str:
    tp = f"count(*) FILTER (WHERE {cond} AND y = 1 AND p = 1)"
    wrong = f"count(*) FILTER (WHERE {cond} AND y <> p)"
    return f"CASE WHEN 2 * {tp} + {wrong} > 0 THEN 2.0 * {tp} / (2 * {tp} + {wrong}) ELSE 0.0 END"


RESULTS = f"""results AS (
  SELECT model_key, 'run-1' AS run_id,
         CAST({acc("split = 'val'")} AS DOUBLE) AS val_accuracy, CAST({f1("split = 'val'")} AS DOUBLE) AS val_f1,
         CAST({acc("split = 'test'")} AS DOUBLE) AS test_accuracy, CAST({f1("split = 'test'")} AS DOUBLE) AS test_f1
  FROM predictions GROUP BY model_key)"""

def summed(width: int) -> str:
    return f"""list_transform(range({width}), lambda k: list_reduce(list_transform(range(k, len(embedding), {width}), lambda i: embedding[i + 1]::DOUBLE),
        lambda s, x: s + x))"""


STARS = f"""logits AS (SELECT vec_id, {summed(5)} AS z, {summed(2)} AS z2 FROM embeddings),
tops AS (SELECT *, list_position(z, list_max(z)) - 1 AS top, list_position(z2, list_max(z2)) - 1 AS top2 FROM logits)"""

# Class sizes: train by largest remainder, the rest in two halves, val again by largest remainder.
SPLIT = """k AS (SELECT quality, count(*) AS n FROM labels GROUP BY quality),
t AS (SELECT quality, n, sum(n) OVER () AS total, sum(n) OVER () - ceil(CAST(0.3 AS DOUBLE) * sum(n) OVER ()) AS want FROM k),
t1 AS (SELECT *, floor(n * want / total) AS base, n * want / total - floor(n * want / total) AS rest FROM t),
t2 AS (SELECT *, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, quality) <= want - sum(base) OVER () THEN 1 ELSE 0 END AS train FROM t1),
v AS (SELECT quality, n - train AS held, sum(n - train) OVER () AS total,
             sum(n - train) OVER () - ceil(CAST(0.5 AS DOUBLE) * sum(n - train) OVER ()) AS want FROM t2),
v1 AS (SELECT *, floor(held * want / total) AS base, held * want / total - floor(held * want / total) AS rest FROM v),
v2 AS (SELECT quality, held, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, quality) <= want - sum(base) OVER () THEN 1 ELSE 0 END AS val FROM v1),
placed AS (SELECT l.*, row_number() OVER (PARTITION BY quality ORDER BY substr(md5('42|' || doc_id), 1, 15), CAST(doc_id AS VARCHAR)) AS place FROM labels l),
splits AS (SELECT p.doc_id, p.quality, p.toxic,
                  CASE WHEN place <= held - val THEN 'test' WHEN place <= held THEN 'val' ELSE 'train' END AS split
           FROM placed p JOIN v2 USING (quality))"""

ACCOUNTS = """target AS (
  SELECT c_name AS subreddit, c_custkey AS subscribers, c_mktsegment AS description, c_acctbal AS created_utc, c_acctbal < 0 AS over18
  FROM customer),
incoming AS (
  SELECT 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS subreddit, count(*) AS subscribers,
         CAST(NULL AS VARCHAR) AS description, CAST(NULL AS DOUBLE) AS created_utc, TRUE AS over18
  FROM orders GROUP BY o_custkey
  UNION ALL
  SELECT s_name, s_suppkey, 'new', s_acctbal, FALSE FROM supplier)"""
UPSERT = f"""WITH {ACCOUNTS}
SELECT * FROM incoming
UNION ALL SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM incoming i WHERE i.subreddit = t.subreddit)"""

SCORED = """scored AS (
  SELECT *, CASE WHEN label < 3 THEN 'mlp_transformer' WHEN label < 6 THEN 'bert_nlptown'
                 WHEN label < 9 THEN 'bert_distilbert' ELSE 'other' END AS wanted,
         1.0 / (1.0 + exp(-list_sum(CAST(embedding AS DOUBLE[])))) AS p,
         CAST(embedding[1:5] AS DOUBLE[]) AS z5, CAST(embedding[1:2] AS DOUBLE[]) AS z2
  FROM embeddings)"""
BACKEND = "sentiment_deep_model@champion"
STAR_MODEL = "nlptown/bert-base-multilingual-uncased-sentiment"
PAIR_MODEL = "distilbert-base-uncased-finetuned-sst-2-english"


def top_probability(z: str) -> str:
    return f"1.0 / list_sum(list_transform({z}, lambda x: exp(x - list_max({z}))))"


def quantile_rows(table: str, column: str, probs: tuple[float, ...]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{column}' AS \"column\", CAST({p} AS DOUBLE) AS prob, "
        f"round(quantile_cont(CAST({column} AS DOUBLE), {p}), 6) AS value FROM {table}"
        for p in probs
    )


def describe_rows(table: str, columns: tuple[str, ...]) -> str:
    def row(c: str) -> str:
        x = f"CAST({c} AS DOUBLE)"
        cuts = ", ".join(f"round(quantile_cont({x}, {p}), 6) AS p{int(p * 100)}" for p in (0.25, 0.5, 0.75))
        return (
            f"SELECT '{c}' AS \"column\", count({c}) AS \"count\", round(avg({x}), 6) AS mean, "
            f"round(stddev_samp({x}), 6) AS std, min({x}) AS \"min\", {cuts}, max({x}) AS \"max\" FROM {table}"
        )

    return " UNION ALL ".join(row(c) for c in columns)


def null_rows(table: str, columns: tuple[str, ...]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM {table}" for c in columns
    )


def box(table: str, column: str, group: str = "") -> str:
    by = f"GROUP BY {group}" if group else ""
    lead = f"{group}, " if group else ""
    link = f"USING ({group})" if group else "ON TRUE"
    return f"""q AS (SELECT {lead}quantile_cont(CAST({column} AS DOUBLE), 0.25) AS a, quantile_cont(CAST({column} AS DOUBLE), 0.5) AS b,
                     quantile_cont(CAST({column} AS DOUBLE), 0.75) AS c FROM {table} {by}),
x AS (SELECT {lead}CAST({column} AS DOUBLE) AS v, a, b, c,
             CAST({column} AS DOUBLE) >= a - 1.5 * (c - a) AND CAST({column} AS DOUBLE) <= c + 1.5 * (c - a) AS fits
      FROM {table} JOIN q {link})
SELECT {lead}count(*) AS n, min(v) AS "min", round(any_value(a), 6) AS q1, round(any_value(b), 6) AS median, round(any_value(c), 6) AS q3,
       max(v) AS "max", min(v) FILTER (WHERE fits) AS whisker_low, max(v) FILTER (WHERE fits) AS whisker_high,
       count(*) FILTER (WHERE NOT fits) AS outliers
FROM x {by}"""


def categorical(table: str, columns: dict[str, str]) -> str:
    long = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {e} AS v FROM {table}" for c, e in columns.items())
    return f"""long AS ({long}),
counted AS (SELECT "column", v, count(*) AS n FROM long WHERE v IS NOT NULL GROUP BY "column", v),
ranked AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, v) AS place FROM counted)
SELECT "column", CAST(sum(n) AS BIGINT) AS "count", count(*) AS "unique", max(v) FILTER (WHERE place = 1) AS top,
       max(n) FILTER (WHERE place = 1) AS freq
FROM ranked GROUP BY "column\""""


def corr_rows(table: str, columns: tuple[str, ...]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM {table}"
        for a in columns
        for b in columns
    )


def rate_rows(table: str, flags: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS feature, round(avg(CASE WHEN {c} THEN 1.0 ELSE 0.0 END), 6) AS proportion FROM {table}"
        for n, c in flags.items()
    )


NOTES = {
    # model key -> family, hyper-parameters, production cost, latency
    "bert_bert-base-multilingual-uncased-sentiment": (
        "bert_sequence_classifier", "hf_model=nlptown/bert-base-multilingual-uncased-sentiment",
        "alto (modelo grande, multilingüe)", "media-alta",
    ),
    "bert_distilbert-base-uncased-finetuned-sst-2-english": (
        "bert_sequence_classifier", "hf_model=distilbert-base-uncased-finetuned-sst-2-english",
        "medio (modelo compacto)", "media",
    ),
    "mlp_transformer": (
        "mlp_classifier + sentence_transformer", "ST=all-MiniLM-L6-v2, hidden=(256,), max_iter=10",
        "medio (embeddings + MLP)", "baja-media (si embeddings precalculados)",
    ),
}


def note(place: int) -> str:
    return "CASE model_key " + " ".join(f"WHEN '{k}' THEN '{v[place]}'" for k, v in NOTES.items()) + " END"


LINEITEM_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
    "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
}
YMD = "CAST(year(ts) AS INTEGER) AS \"YYYY\", CAST(month(ts) AS INTEGER) AS \"MM\", CAST(day(ts) AS INTEGER) AS \"DD\""
RANKED_USERS = """SELECT author AS subreddit, count(*) AS n_posts, min(event_id) AS first_pos FROM {pool} GROUP BY author
ORDER BY n_posts DESC, first_pos LIMIT {n}"""
EVENT_TYPED = f"events_typed AS (SELECT *, {EPOCH} AS created_utc FROM events)"

ORACLES: dict[str, str] = {
    # sources and sinks
    "scan_ndjson": f"""WITH {POSTS} SELECT post_id AS id, subreddit, author, score, over_18, created_utc, is_self,
        '20240131_0000' AS batch_ts FROM posts""",
    "sink_ndjson_roundtrip": "SELECT conv_id, turn, role, text, '20240101_' || role AS batch_ts FROM conversations",
    "sanitize_values": """SELECT event_id, '{"event_type":"' || event_type || '","user_id":' || user_id || '}' AS pair,
        '["' || event_type || '"]' AS list FROM events""",
    "partition_by_date": f"WITH {POSTS} SELECT post_id, score, '20240131_0000' AS batch_ts, {YMD} FROM posts",
    "scan_parquet_all": "SELECT o_orderkey, o_custkey, o_totalprice, substr(o_orderpriority, 1, 1) AS batch_ts FROM orders",
    "union_batches": """SELECT event_id, CASE WHEN event_type = 'view' THEN 'u' ELSE '' END || user_id AS user_id, event_type, value,
        CASE WHEN event_type = 'click' THEN NULL ELSE props END AS props FROM events""",
    "read_split": f"WITH {SPLIT} SELECT doc_id, quality, toxic, split FROM splits WHERE split = 'val'",
    "embedding_metadata": """WITH s AS (SELECT CASE WHEN label < 7 THEN 'train' WHEN label < 9 THEN 'val' ELSE 'test' END AS split, embedding FROM embeddings)
        SELECT 'org/encoder' AS model_name, split, count(*) AS n, CAST(min(len(embedding)) AS INTEGER) AS dim,
               'org_encoder_' || split || '_20240131T102030' AS artifact FROM s GROUP BY split""",
    # bronze
    "bronze_posts": f"WITH {POSTS} SELECT * EXCLUDE (event_id, ts) FROM posts",
    "bronze_comments": f"WITH {COMMENTS} SELECT * FROM comments",
    "bronze_subreddits": """SELECT chr(9) || lower(s_name) || ' ' AS subreddit,
        CASE WHEN s_acctbal < 0 THEN NULL ELSE CAST(trunc(s_acctbal) AS BIGINT) END AS subscribers,
        'nation ' || s_nationkey AS description, CAST(s_suppkey AS DOUBLE) AS created_utc, s_nationkey < 5 AS over18 FROM supplier""",
    "bronze_usersubs": """SELECT 'user' || user_id AS username, event_type AS subreddit, CAST(event_id AS VARCHAR) AS last_post_id,
        user_id + CAST(0.5 AS DOUBLE) AS last_created_utc FROM events""",
    "bronze_hotlist": """SELECT c_name AS subreddit, c_mktsegment AS strategy, CAST(trunc(c_acctbal) AS BIGINT) AS posts_limit,
        c_nationkey <> 0 AS include_nsfw FROM customer""",
    # scalar functions
    "cast_int_lenient": """SELECT event_id, CASE event_type WHEN 'click' THEN user_id WHEN 'view' THEN CAST(trunc(value) AS BIGINT)
        WHEN 'error' THEN CAST(trunc(-value) AS BIGINT) END AS as_int FROM events""",
    "cast_float_lenient": """SELECT event_id, CASE event_type WHEN 'click' THEN CAST(user_id AS DOUBLE) WHEN 'view' THEN value
        WHEN 'error' THEN -value END AS as_float FROM events""",
    "cast_bool_lenient": """SELECT event_id, CASE event_type WHEN 'click' THEN TRUE WHEN 'view' THEN FALSE WHEN 'error' THEN TRUE
        WHEN 'purchase' THEN FALSE END AS from_word, user_id <> 8 AS from_number FROM events""",
    "normalize_key": "SELECT c_custkey, upper(c_name) AS key FROM customer",
    "slugify": """SELECT page_id, regexp_replace(replace(trim(lower(url)), ' ', '_'), '[^a-z0-9_-]+', '', 'g') AS slug FROM pages""",
    "search_tag": """SELECT p_partkey, 'q-' || CAST(CAST('0x' || substr(md5(p_name), 1, 7) AS BIGINT) AS VARCHAR) AS tag FROM part""",
    "epoch_to_ts": """SELECT event_id, epoch_us(ts) AS micros, strftime(ts, '%Y%m%d_%H%M') AS batch_tag,
        strftime(ts, '%Y%m%dT%H%M%S') AS stamp FROM events""",
    "nfkc_normalize": "SELECT doc_id, 'fine A1 ...  ' || text AS normal FROM documents",
    "text_features": f"""WITH {COMMENTS} SELECT comment_id, CAST(length(body) AS INTEGER) AS text_len, {words("body")} AS word_count,
        contains(body, '!') AS has_exclamation, contains(body, '?') AS has_question FROM comments""",
    "clean_text": f"""WITH {COMMENTS} SELECT comment_id, {cleaned("body")} AS clean_text FROM comments""",
    "to_json_record": """SELECT p_partkey, '{"p_name":"' || p_name || '","p_size":' || p_size || ',"p_brand":"' || p_brand || '"}' AS record
        FROM part""",
    "artifact_names": """SELECT o_orderkey, 'org_' || o_orderpriority || '_' || o_orderstatus || '_' ||
        strftime(o_orderdate, '%Y%m%dT%H%M%S') AS name FROM orders""",
    # cleaning and features
    "drop_tombstones": f"""WITH {COMMENTS}, {TEXTS} SELECT comment_id, author IS NOT NULL AS has_author,
        CAST(created_utc * 1000000 AS BIGINT) AS created_us FROM live""",
    "drop_null_bodies": f"""WITH {COMMENTS}, {LIVE} SELECT comment_id, CAST(length(body) AS INTEGER) AS text_len, {words("body")} AS word_count
        FROM live WHERE length(body) > 2""",
    "keep_null_bodies": f"""WITH {COMMENTS}, texts AS (SELECT comment_id, coalesce(body, 'None') AS body FROM comments)
        SELECT comment_id, CAST(length(body) AS INTEGER) AS text_len, {words("body")} AS word_count FROM texts
        WHERE body NOT IN ('[deleted]', '[removed]') AND length(body) > 2""",
    "wrangle_features": f"""WITH {COMMENTS}, {TEXTS}, {FEATURES}
        SELECT comment_id, text_len, word_count, has_exclamation, has_question, has_author FROM features""",
    "wrangle_clean": f"""{WRANGLE} SELECT comment_id, md5(clean_text) AS clean_md5, CAST(length(clean_text) AS INTEGER) AS clean_len
        FROM cleaned""",
    "winsorize": f"""{WRANGLE} SELECT comment_id, round(score_clipped, 6) AS score_clipped,
        round(text_len_clipped, 6) AS text_len_clipped FROM clipped""",
    "median_label": """SELECT o_orderkey, CASE WHEN o_totalprice >= (SELECT quantile_cont(o_totalprice, 0.5) FROM orders)
        THEN 1 ELSE 0 END AS sentiment FROM orders""",
    "wrangle_training_set": f"""{WRANGLE} SELECT comment_id, clean_text, round(score_clipped, 6) AS score_clipped,
        round(text_len_clipped, 6) AS text_len_clipped, word_count, has_exclamation, has_question,
        CAST(created_utc * 1000000 AS BIGINT) AS created_dt, is_submitter,
        CASE WHEN score_clipped >= (SELECT quantile_cont(score_clipped, 0.5) FROM cleaned) THEN 1 ELSE 0 END AS sentiment
        FROM cleaned""",
    # profiling
    "null_profile": f"WITH {COMMENTS} " + null_rows(
        "comments",
        ("comment_id", "post_id", "author", "body", "created_utc", "parent_id", "link_id", "score", "is_submitter"),
    ),
    "column_info": " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS \"column\", '{kind}' AS \"type\", count({c}) AS non_null FROM lineitem"
        for i, (c, kind) in enumerate(LINEITEM_TYPES.items())
    ),
    "flag_rates": f"WITH {COMMENTS} " + rate_rows(
        "comments",
        {
            "deleted_rate": "body = '[deleted]'",
            "removed_rate": "body = '[removed]'",
            "has_author": "author IS NOT NULL",
            "has_exclamation": "contains(body, '!')",
            "has_question": "contains(body, '?')",
        },
    ),
    "retention": f"""WITH {COMMENTS}, {LIVE} SELECT (SELECT count(*) FROM comments) AS total_rows, count(*) AS kept_rows,
        round(count(*) / (SELECT count(*) FROM comments), 6) AS retained FROM live""",
    "describe_numeric": describe_rows("lineitem", ("l_quantity", "l_extendedprice", "l_discount", "l_suppkey")),
    "describe_categorical": f"WITH {COMMENTS}, " + categorical(
        "comments", {"author": "author", "body": "body", "is_submitter": "CAST(is_submitter AS VARCHAR)"}
    ),
    "class_distribution": """SELECT quality, count(*) AS n, round(count(*) / (SELECT count(*) FROM labels), 6) AS share
        FROM labels GROUP BY quality""",
    "duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber
        HAVING count(*) > 1""",
    "uniqueness": """SELECT count(*) AS total_rows, count(DISTINCT doc_id) AS distinct_keys,
        count(*) = count(DISTINCT doc_id) AS is_unique FROM documents""",
    "quantiles": quantile_rows("orders", "o_totalprice", (0.01, 0.25, 0.5, 0.75, 0.99))
    + " UNION ALL " + quantile_rows("orders", "o_custkey", (0.0, 0.5, 1.0)),
    "corr_matrix": corr_rows("lineitem", ("l_quantity", "l_extendedprice", "l_discount")),
    "histogram": """WITH e AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi, (max(o_totalprice) - min(o_totalprice)) / 20 AS w FROM orders),
        b AS (SELECT CAST(least(floor((o_totalprice - lo) / w), 19) AS INTEGER) AS bin, lo, w FROM orders, e)
        SELECT bin, round(any_value(lo + bin * w), 6) AS bin_low, round(any_value(lo + (bin + 1) * w), 6) AS bin_high, count(*) AS n
        FROM b GROUP BY bin""",
    "value_histogram": "SELECT n_chars, count(*) AS n FROM documents WHERE n_chars IS NOT NULL GROUP BY n_chars",
    "box_stats": "WITH " + box("documents", "n_chars"),
    "box_stats_grouped": "WITH " + box("lineitem", "l_extendedprice", "l_returnflag"),
    "quartile_bucket": """WITH q AS (SELECT quantile_cont(n_chars, 0.25) AS a, quantile_cont(n_chars, 0.5) AS b, quantile_cont(n_chars, 0.75) AS c FROM documents)
        SELECT doc_id, CASE WHEN n_chars <= a THEN 'Q1' WHEN n_chars <= b THEN 'Q2' WHEN n_chars <= c THEN 'Q3' ELSE 'Q4' END AS len_bucket
        FROM documents, q""",
    "kth_example": """WITH m AS (SELECT quantile_cont(CAST(n_chars AS DOUBLE), 0.5) AS med FROM documents),
        l AS (SELECT doc_id, n_chars, CASE WHEN n_chars >= med THEN 1 ELSE 0 END AS sentiment FROM documents, m),
        r AS (SELECT *, row_number() OVER (PARTITION BY sentiment ORDER BY CASE WHEN sentiment = 1 THEN -n_chars ELSE n_chars END, doc_id) AS place FROM l)
        SELECT doc_id, n_chars, sentiment FROM r WHERE (sentiment = 0 AND place = 1) OR (sentiment = 1 AND place = 111)""",
    "head_rows": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5",
    # dedupe, dimensions, facts, upserts
    "dedupe_latest": f"""WITH r AS (SELECT user_id || '/' || event_type AS post_id, event_id, value,
        row_number() OVER (PARTITION BY user_id, event_type ORDER BY {EPOCH} DESC, event_id DESC) AS place FROM events)
        SELECT post_id, event_id, value FROM r WHERE place = 1""",
    "first_post_per_group": "SELECT event_type, min(event_id) AS event_id FROM events GROUP BY event_type",
    "dim_author": f"""WITH {POSTS}, {COMMENTS} SELECT author AS author_name FROM posts WHERE author IS NOT NULL
        UNION SELECT author FROM comments WHERE author IS NOT NULL""",
    "dim_subreddit": """SELECT upper(s_name) AS subreddit, CASE WHEN s_acctbal < 0 THEN 0 ELSE CAST(trunc(s_acctbal) AS BIGINT) END AS subscribers,
        'nation ' || s_nationkey AS description, CAST(s_suppkey AS DOUBLE) AS created_utc, s_nationkey < 5 AS over18 FROM supplier""",
    "fact_posts": """SELECT CAST(event_id AS VARCHAR) AS post_id, 'SUPPLIER#' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS subreddit, value,
        EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = e.user_id) AS has_dim FROM events e""",
    "fact_comments": f"""WITH {COMMENTS} SELECT comment_id, post_id, author, score, is_submitter,
        EXISTS (SELECT 1 FROM events e WHERE CAST(e.event_id AS VARCHAR) = c.post_id) AS has_post FROM comments c""",
    "silver_posts": f"WITH {POSTS} SELECT post_id, upper(trim(replace(subreddit, chr(9), ''))) AS subreddit, author, score, num_comments, over_18 FROM posts",
    "orphan_comments": f"""WITH {COMMENTS} SELECT comment_id, post_id FROM comments c
        WHERE NOT EXISTS (SELECT 1 FROM events e WHERE CAST(e.event_id AS VARCHAR) = c.post_id)""",
    "orphan_report": f"""WITH {COMMENTS}
        SELECT 'posts' AS child, 'subreddit' AS reference, count(*) AS orphans FROM events e
        WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = e.user_id)
        UNION ALL SELECT 'comments', 'post_id', count(*) FROM comments c
        WHERE NOT EXISTS (SELECT 1 FROM events e WHERE CAST(e.event_id AS VARCHAR) = c.post_id)""",
    "upsert_full_row": UPSERT,
    "store_upsert": UPSERT,
    "insert_ignore": "SELECT DISTINCT 'user' || user_id AS author_name FROM events",
    "store_insert_ignore": "SELECT DISTINCT 'user' || user_id AS author_name FROM events",
    # discovery, listings, search
    "discover_ranked": f"WITH {POSTS}, pool AS (SELECT * FROM posts WHERE NOT coalesce(over_18, FALSE)) "
    + RANKED_USERS.format(pool="pool", n=20),
    "discover_popular": """WITH h AS (SELECT c_custkey AS position, c_name AS subreddit,
        CASE WHEN c_acctbal < 0 THEN TRUE WHEN c_acctbal > 5000 THEN FALSE END AS over18 FROM customer)
        SELECT * FROM h WHERE NOT coalesce(over18, FALSE) ORDER BY position LIMIT 40""",
    "discover_hot": f"""WITH {POSTS}, pool AS (SELECT * FROM posts WHERE NOT coalesce(over_18, FALSE)), r AS ({RANKED_USERS.format(pool="pool", n=10)})
        SELECT subreddit, 'all_hot' AS strategy, CAST(NULL AS BIGINT) AS posts_limit, FALSE AS include_nsfw FROM r""",
    "discover_top_day": f"""WITH {POSTS}, day AS (SELECT * FROM posts WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 1 DAY),
        r AS ({RANKED_USERS.format(pool="day", n=10)})
        SELECT subreddit, 'all_top_day' AS strategy, CAST(NULL AS BIGINT) AS posts_limit, TRUE AS include_nsfw FROM r""",
    "search_posts": """SELECT doc_id, n_chars FROM documents WHERE contains(lower(text || ' ' || source), 'the')
        AND contains(lower(text || ' ' || source), 'en') ORDER BY n_chars DESC, doc_id LIMIT 100""",
    "top_posts_window": """WITH r AS (SELECT event_type, event_id, value, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS place
        FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY) SELECT event_type, event_id, value, CAST(place AS INTEGER) AS place FROM r WHERE place <= 25""",
    "new_posts": """WITH r AS (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id) AS place FROM events)
        SELECT event_type, event_id, CAST(place AS INTEGER) AS place FROM r WHERE place <= 25""",
    "user_recent_communities": f"""SELECT 'user8' AS username, event_type AS subreddit, CAST(event_id AS VARCHAR) AS last_post_id,
        {EPOCH} AS last_created_utc FROM events WHERE user_id = 8 ORDER BY ts DESC, CAST(event_id AS VARCHAR) LIMIT 50""",
    # splits and samples
    "stratified_split": f"WITH {SPLIT} SELECT doc_id, quality, split FROM splits",
    "sample_exact": """WITH r AS (SELECT doc_id, n_chars, row_number() OVER (ORDER BY substr(md5('42|' || doc_id), 1, 15), CAST(doc_id AS VARCHAR)) AS place FROM documents)
        SELECT doc_id, n_chars FROM r WHERE place <= (SELECT CAST(floor(count(*) * CAST(0.37 AS DOUBLE)) AS BIGINT) FROM documents)""",
    # vectors, models, scoring
    "softmax_argmax": f"""WITH {STARS} SELECT vec_id, CAST(top AS INTEGER) AS top,
        {", ".join(f"round(exp(z[{i + 1}] - list_max(z)) / list_sum(list_transform(z, lambda x: exp(x - list_max(z)))), 6) AS p{i}" for i in range(5))},
        round({top_probability("z")}, 6) AS p_top FROM tops""",
    "logits_to_binary": f"""WITH {STARS} SELECT vec_id, CASE WHEN top >= 3 THEN 1 ELSE 0 END AS from_stars,
        CASE WHEN top2 = 1 THEN 1 ELSE 0 END AS from_pair FROM tops""",
    "logits_to_label": f"""WITH {STARS} SELECT vec_id, CASE WHEN top <= 1 THEN 'negative' WHEN top = 2 THEN 'neutral' ELSE 'positive' END AS from_stars,
        CASE WHEN top2 = 1 THEN 'positive' ELSE 'negative' END AS from_pair FROM tops""",
    "scaler_fit": """WITH u AS (SELECT unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings)
        SELECT CAST(dim AS INTEGER) AS dim, count(*) AS n, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std FROM u GROUP BY dim""",
    "scaler_transform": """WITH u AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings),
        f AS (SELECT dim, avg(v) AS m, stddev_pop(v) AS s FROM u WHERE label < 7 GROUP BY dim),
        z AS (SELECT vec_id, dim, (v - m) / s AS z FROM u JOIN f USING (dim))
        SELECT vec_id, round(max(z) FILTER (WHERE dim = 0), 6) AS s0, round(max(z) FILTER (WHERE dim = 1), 6) AS s1,
               round(max(z) FILTER (WHERE dim = 63), 6) AS s63, round(sum(z ORDER BY dim), 6) AS total FROM z GROUP BY vec_id""",
    "embed_texts": """SELECT doc_id, CAST(length(text) AS INTEGER) AS n_len, CAST(length(text) - length(replace(text, 'e', '')) AS INTEGER) AS n_e,
        CAST(length(text) - length(replace(text, ' ', '')) AS INTEGER) AS n_blank FROM documents""",
    "binary_metrics": f"WITH {PREDICTIONS} SELECT count(*) AS n, round({acc()}, 6) AS accuracy, round({f1()}, 6) AS f1 FROM predictions",
    "metrics_no_positives": """SELECT quality, count(*) AS n, CAST(1.0 AS DOUBLE) AS accuracy, CAST(0.0 AS DOUBLE) AS f1
        FROM labels GROUP BY quality""",
    "evaluate_by_split": f"""WITH {PREDICTIONS}, {RESULTS} SELECT model_key, round(val_accuracy, 6) AS val_accuracy, round(val_f1, 6) AS val_f1,
        round(test_accuracy, 6) AS test_accuracy, round(test_f1, 6) AS test_f1 FROM results""",
    "model_enrich": f"""WITH {PREDICTIONS}, {RESULTS} SELECT model_key, run_id, {note(0)} AS family, {note(1)} AS hyperparams,
        {note(2)} AS cost_prod, {note(3)} AS latency_prod FROM results""",
    "unpivot_metrics": f"""WITH {PREDICTIONS}, {RESULTS} SELECT model_key, 'val_f1' AS split, round(val_f1, 6) AS f1_score FROM results
        UNION ALL SELECT model_key, 'test_f1', round(test_f1, 6) FROM results""",
    "unpivot_accuracy": f"""WITH {PREDICTIONS}, {RESULTS} SELECT model_key, 'val_accuracy' AS split, round(val_accuracy, 6) AS accuracy FROM results
        UNION ALL SELECT model_key, 'test_accuracy', round(test_accuracy, 6) FROM results""",
    "model_compare": f"""WITH {PREDICTIONS}, {RESULTS} SELECT model_key, run_id, round(val_accuracy, 6) AS val_accuracy, round(val_f1, 6) AS val_f1,
        round(test_accuracy, 6) AS test_accuracy, round(test_f1, 6) AS test_f1, round(val_f1 - test_f1, 6) AS gap_f1_val_test,
        round(val_accuracy - test_accuracy, 6) AS gap_acc_val_test,
        CASE WHEN abs(val_f1 - test_f1) < 0.02 THEN 'stable' WHEN val_f1 - test_f1 > 0.05 THEN 'overfit' ELSE 'moderate' END AS signal
        FROM results""",
    "champion_select": f"""WITH {PREDICTIONS}, {RESULTS} SELECT model_key AS best_model_key, round(val_f1, 6) AS best_val_f1,
        round(test_f1, 6) AS best_test_f1,
        CASE WHEN model_key = 'mlp_transformer' THEN (SELECT max(CAST(n_nationkey AS BIGINT)) FROM nation) END AS champion_version
        FROM results ORDER BY val_f1 DESC, model_key LIMIT 1""",
    "comparison_summary": f"""WITH {PREDICTIONS}, {RESULTS}, b AS (SELECT model_key FROM results ORDER BY val_f1 DESC, model_key LIMIT 1)
        SELECT model_key AS best_model_key, CAST((SELECT count(*) FROM results) AS INTEGER) AS n_models, model_key AS first_model FROM b""",
    "score_mlp": f"""WITH {SCORED} SELECT vec_id, CASE WHEN p >= 0.5 THEN 'positive' ELSE 'negative' END AS label, round(p, 6) AS score,
        'mlp_transformer' AS model_key, '{BACKEND}' AS backend_model_name, CAST(NULL AS VARCHAR) AS warning,
        round(greatest(p, 1.0 - p), 6) AS confidence FROM scored""",
    "score_router": f"""WITH {SCORED}, s AS (SELECT vec_id, wanted,
        CASE wanted WHEN 'bert_nlptown' THEN CASE WHEN list_position(z5, list_max(z5)) <= 2 THEN 'negative' WHEN list_position(z5, list_max(z5)) = 3 THEN 'neutral' ELSE 'positive' END
                    WHEN 'bert_distilbert' THEN CASE WHEN list_position(z2, list_max(z2)) = 2 THEN 'positive' ELSE 'negative' END
                    ELSE CASE WHEN p >= 0.5 THEN 'positive' ELSE 'negative' END END AS label,
        CASE wanted WHEN 'bert_nlptown' THEN {top_probability("z5")} WHEN 'bert_distilbert' THEN {top_probability("z2")} ELSE p END AS score FROM scored)
        SELECT vec_id, label, round(score, 6) AS score, CASE WHEN wanted = 'other' THEN 'mlp_transformer' ELSE wanted END AS model_key,
        CASE wanted WHEN 'bert_nlptown' THEN '{STAR_MODEL}' WHEN 'bert_distilbert' THEN '{PAIR_MODEL}' ELSE '{BACKEND}' END AS backend_model_name,
        CASE WHEN wanted = 'other' THEN 'model_key desconocido ''other'', se usó mlp_transformer.' END AS warning,
        round(greatest(score, 1.0 - score), 6) AS confidence FROM s""",
    "score_injected": """SELECT doc_id, CASE WHEN length(text) - length(replace(text, 'e', '')) > length(text) - length(replace(text, 'a', ''))
        THEN 'positive' ELSE 'negative' END AS label FROM documents""",
    "score_threshold": f"WITH {SCORED} SELECT vec_id, round(p, 6) >= 0.7 AS is_confident FROM scored",
    "polarity_bucket": """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'negative' WHEN 'HOUSEHOLD' THEN 'positive'
        WHEN 'MACHINERY' THEN 'neutral' ELSE 'unknown' END AS polarity FROM customer""",
    # streams
    "stream_bronze": f"WITH {POSTS} SELECT post_id, score, over_18, '20240131_0000' AS batch_ts, {YMD} FROM posts",
    # jobs, store tables and catalog
    "run_medallion": f"""WITH {COMMENTS} SELECT comment_id, post_id, author, score, is_submitter,
        EXISTS (SELECT 1 FROM events e WHERE CAST(e.event_id AS VARCHAR) = c.post_id) AS has_post FROM comments c""",
    "silver_tables": f"""WITH {POSTS}, {COMMENTS} SELECT 'dim_subreddit' AS name, count(*) AS n FROM supplier
        UNION ALL SELECT 'fact_posts', count(*) FROM posts UNION ALL SELECT 'fact_comments', count(*) FROM comments
        UNION ALL SELECT 'dim_author', count(*) FROM (SELECT author FROM posts WHERE author IS NOT NULL UNION SELECT author FROM comments WHERE author IS NOT NULL)
        UNION ALL SELECT 'usersubs', 0 UNION ALL SELECT 'hot_sublists', 0""",
    "discover_medallion": f"""WITH {POSTS}, named AS (SELECT *, upper(trim(replace(subreddit, chr(9), ''))) AS name FROM posts),
        r AS (SELECT name, count(*) AS n, min(post_id) AS pos FROM named WHERE NOT coalesce(over_18, FALSE) GROUP BY name ORDER BY n DESC, pos LIMIT 3),
        p AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY score DESC, post_id) AS place FROM named WHERE name IN (SELECT name FROM r))
        SELECT post_id, name AS subreddit, score, 'all_hot' AS strategy FROM p WHERE place <= 40""",
    "top_posts_of": f"""WITH {POSTS}, p AS (SELECT trim(replace(subreddit, chr(9), '')) AS subreddit, post_id, score,
        row_number() OVER (PARTITION BY subreddit ORDER BY score DESC, event_id) AS place FROM posts
        WHERE trim(replace(subreddit, chr(9), '')) IN ('click', 'purchase') AND ts >= (SELECT max(ts) FROM events) - INTERVAL 30 DAY)
        SELECT subreddit, post_id, score, CAST(place AS INTEGER) AS place FROM p WHERE place <= 1500""",
    "catalog_scan": f"WITH {POSTS} SELECT post_id, upper(trim(replace(subreddit, chr(9), ''))) AS subreddit, author, score, num_comments, over_18 FROM posts",
    "store_comments": f"WITH {COMMENTS} SELECT comment_id, post_id, author, score, is_submitter FROM comments",
    "store_no_rows": """SELECT c_name AS subreddit, c_custkey AS subscribers, c_mktsegment AS description, c_acctbal AS created_utc,
        c_acctbal < 0 AS over18, TRUE AS same_version FROM customer""",
    "list_store_tables": f"""WITH {POSTS}, {COMMENTS} SELECT 'subreddits' AS name, count(*) AS n FROM supplier
        UNION ALL SELECT 'posts', count(*) FROM posts UNION ALL SELECT 'comments', count(*) FROM comments
        UNION ALL SELECT 'authors', count(*) FROM (SELECT author FROM posts WHERE author IS NOT NULL UNION SELECT author FROM comments WHERE author IS NOT NULL)""",
    "profile_comments": f"""WITH {COMMENTS}, {LIVE}, dated AS (SELECT *, author IS NOT NULL AS has_author FROM comments),
        f AS (SELECT *, length(body) AS text_len, contains(body, '!') AS has_exclamation, contains(body, '?') AS has_question FROM live),
        probs AS (SELECT unnest([0.01, 0.25, 0.5, 0.75, 0.99]::DOUBLE[]) AS p),
        out AS (
          SELECT 'null_profile' AS part, k AS name, v AS value FROM (
            UNPIVOT (SELECT {", ".join(f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) AS {c}" for c in
              ("comment_id", "post_id", "author", "body", "created_utc", "parent_id", "link_id", "score", "is_submitter", "has_author"))},
              CAST(count(*) FILTER (WHERE created_utc IS NULL) AS DOUBLE) AS created_dt FROM dated) ON COLUMNS(*) INTO NAME k VALUE v)
          UNION ALL SELECT 'tombstone_rates', 'deleted_rate', count(*) FILTER (WHERE body = '[deleted]') / count(*) FROM comments
          UNION ALL SELECT 'tombstone_rates', 'removed_rate', count(*) FILTER (WHERE body = '[removed]') / count(*) FROM comments
          UNION ALL SELECT 'mark_rates', 'has_exclamation', count(*) FILTER (WHERE has_exclamation) / count(*) FROM f
          UNION ALL SELECT 'mark_rates', 'has_question', count(*) FILTER (WHERE has_question) / count(*) FROM f
          UNION ALL SELECT 'score_quantiles', CAST(p AS VARCHAR), (SELECT quantile_cont(CAST(score AS DOUBLE), [0.01, 0.25, 0.5, 0.75, 0.99]) FROM f)[i] FROM (SELECT p, row_number() OVER (ORDER BY p) AS i FROM probs)
          UNION ALL SELECT 'length_quartiles', CAST(p AS VARCHAR), (SELECT quantile_cont(CAST(text_len AS DOUBLE), [0.25, 0.5, 0.75]) FROM f)[i] FROM (SELECT p, row_number() OVER (ORDER BY p) AS i FROM probs WHERE p BETWEEN 0.25 AND 0.75)
          UNION ALL SELECT 'describe_categorical', 'author', count(DISTINCT author) FROM comments
          UNION ALL SELECT 'describe_categorical', 'body', count(DISTINCT body) FROM comments
          UNION ALL SELECT 'describe_categorical', 'is_submitter', count(DISTINCT is_submitter) FROM comments
          UNION ALL SELECT 'describe_categorical', 'has_author', count(DISTINCT has_author) FROM dated
          UNION ALL SELECT 'score_by_exclamation', CAST(has_exclamation AS VARCHAR), quantile_cont(CAST(score AS DOUBLE), 0.5) FROM f GROUP BY has_exclamation
          UNION ALL SELECT 'retention', 'total_rows', count(*) FROM comments
          UNION ALL SELECT 'retention', 'kept_rows', count(*) FROM live)
        SELECT part, name, round(value, 6) AS value FROM out""",
    "network_train_score": f"""WITH labels AS (SELECT vec_id AS doc_id, CAST(label >= 5 AS INTEGER) AS quality, 0 AS toxic FROM embeddings), {SPLIT}
        SELECT doc_id AS id, split, quality AS label, TRUE AS class_follows, TRUE AS is_probability FROM splits""",
    "hpo_random_search": "SELECT *, TRUE AS is_scored, TRUE AS best_is_first FROM (VALUES "
    + ", ".join(f"({i}, {t.hidden}, {t.alpha!r}::DOUBLE, {t.rate!r}::DOUBLE, {t.batch_size}, {t.max_iter})" for i, t in enumerate(draw_trials()))
    + ") AS t(trial, hidden, alpha, rate, batch_size, max_iter)",
    "stream_dedupe": "SELECT CAST(event_id AS VARCHAR) AS post_id, event_type, value FROM events",
    "stream_upsert": f"""WITH r AS (SELECT 'user' || user_id AS author, CAST(event_id AS VARCHAR) AS post_id, value,
        row_number() OVER (PARTITION BY user_id ORDER BY {EPOCH} DESC, CAST(event_id AS VARCHAR) DESC) AS place FROM events)
        SELECT author, post_id, value FROM r WHERE place = 1""",
    "stream_score": f"""WITH {SCORED} SELECT vec_id, CASE WHEN p >= 0.5 THEN 'positive' ELSE 'negative' END AS label, round(p, 6) AS score
        FROM scored""",
}
