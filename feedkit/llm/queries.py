"""The registered queries of this subpackage, and their SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedkit.llm import (
    classifier,
    decontaminate,
    filter_audit,
    licenses,
    mixing,
    ngram_join,
    pii,
    pitman_yor,
    quality,
    resampling,
    tokens,
    toxicity,
    warc,
)
from feedkit.llm.text import count_words, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def query(name: str, sql: str | None = None):
    """Registers the decorated function under ``name``."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


@query("op1_token_output")
def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_digests(tokens.write_tokens(table(spark, sf_dir, "documents"), TOKENIZER))


@query(
    "op9_warc",
    """
    WITH p AS (
        SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages
    ), f AS (
        SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY d) END AS first FROM p
    )
    SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
           CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN page_id > first THEN first END AS refers_to
    FROM f
    """,
)
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_warc(warc.mark_revisits(table(spark, sf_dir, "pages")))
    return warc.read_warc(manifest).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query("op4_mixing")
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text", count_words("text").alias("size"))
    docs = docs.withColumn("liking", mixing.by_length("size"))
    return mixing.mix(docs, "size", preference="liking").select("doc_id", "size", "source_size", "target", "taken", "copies")


@query("op10_pii")
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["no"] < len(pii.BASE))

    def count(kind):
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id",
        *[count(kind) for kind in pii.BASE],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("pii")).alias("spans"),
    )


_STOP_WORDS = ", ".join(f"'{w.decode()}'" for w in sorted(quality.STOP_WORDS))


@query(
    "op2_quality_rules",
    rf"""
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
               list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
        FROM documents
    ), windows AS (
        SELECT doc_id, i, w[i:i + 2] AS g, count(*) OVER (PARTITION BY doc_id, w[i:i + 2]) AS times
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)
    ), repeated AS (
        SELECT doc_id, count(DISTINCT p) AS n
        FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE times > 1) GROUP BY doc_id
    ), m AS (
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
               CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
               CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
               CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, len(l) AS n_lines,
               length(regexp_replace(t, '[^A-Z]', '', 'g')) AS upper_, length(regexp_replace(t, '[^a-z]', '', 'g')) AS lower_,
               len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS lettered,
               len(list_filter([{_STOP_WORDS}], lambda x: list_contains(list_transform(w, lambda y: lower(y)), x))) AS stops,
               len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*\x{{2022}}]'))) AS bulleted,
               len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|\x{{2026}})[\x20\x09-\x0D]*$'))) AS dotted,
               len(list_distinct(w)) AS different
        FROM d LEFT JOIN repeated r ON r.doc_id = d.doc_id
    ), b AS (
        SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 3 * n_words OR word_chars > 10 * n_words
                OR 10 * n_dup_lines > 4 * n_lines OR 10 * upper_ > 3 * (upper_ + lower_) OR 10 * lettered < 8 * n_words
                OR stops < 2 OR 10 * bulleted > 9 * n_lines OR 10 * dotted > 3 * n_lines
                OR 20 * different < n_words) AS kept
    FROM b
    """,
)
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality.judge(docs, quality.ordered(docs))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query(
    "op5_decontaminate",
    r"""
    WITH d AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
    ), b AS (
        SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark
    ), windows AS (
        SELECT DISTINCT item, least(len(w), 10) AS k, w[i:i + least(len(w), 10) - 1] AS g
        FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)
    ), places AS (
        SELECT doc_id, p, k, w[p:p + k - 1] AS g
        FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS p
              FROM d, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)
    ), found AS (
        SELECT doc_id, p, places.k, item FROM places JOIN windows ON places.k = windows.k AND places.g = windows.g
    ), hits AS (
        SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM found) GROUP BY doc_id
    ), named AS (
        SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
    )
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hits.n, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(named.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
           coalesce(hits.n, 0) > 0 AS contaminated
    FROM d LEFT JOIN hits ON hits.doc_id = d.doc_id LEFT JOIN named ON named.doc_id = d.doc_id
    """,
)
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate.mark_contaminated(docs, table(spark, sf_dir, "benchmark"))
    return marked.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op8_quality_classifier")
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = classifier.fit(docs, table(spark, sf_dir, "labels"))
    scored = classifier.score(docs, model)
    predicted = (F.col("score") >= 0.3).cast("int").alias("predicted")
    return scored.select("doc_id", classifier.held_out("doc_id").alias("held_out"), "score", predicted)


_NOTICES = ", ".join(
    "({}, '{}', '{}')".format(i, name, notice.replace("'", "''")) for i, (name, notice) in enumerate(licenses.TEMPLATES)
)
_FOLDED = (
    "regexp_extract_all(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)


@query(
    "op7_license_scan",
    f"""
    WITH templates(template, license, notice) AS (VALUES {_NOTICES}), t AS (
        SELECT DISTINCT template, license, w[i:i + 4] AS g
        FROM (SELECT *, unnest(range(1, len(w) - 3)) AS i FROM (SELECT *, {_FOLDED.format("notice")} AS w FROM templates))
    ), sized AS (
        SELECT *, count(*) OVER (PARTITION BY template) AS n FROM t
    ), classed AS (
        SELECT *, CAST(pow(2, floor(log2(n))) AS BIGINT) AS step FROM sized
    ), d AS (
        SELECT doc_id, i - 1 AS p, w[i:i + 4] AS g
        FROM (SELECT *, unnest(range(1, len(w) - 3)) AS i
              FROM (SELECT doc_id, {_FOLDED.format("text")} AS w FROM documents))
    ), met AS (
        SELECT doc_id, template, license, n, p // step AS w, d.g FROM d JOIN classed ON d.g = classed.g
    ), held AS (
        SELECT doc_id, template, license FROM (SELECT *, unnest([w, w - 1, w - 2]) AS j FROM met) WHERE j >= 0
        GROUP BY doc_id, template, license, n, j HAVING 100 * count(DISTINCT g) >= 80 * n
    ), named AS (
        SELECT doc_id, count(DISTINCT template) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS names
        FROM held GROUP BY doc_id
    )
    SELECT documents.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_templates, coalesce(names, '') AS licenses
    FROM documents LEFT JOIN named ON named.doc_id = documents.doc_id
    """,
)
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_digest(table(spark, sf_dir, "documents"))


@query(
    "op3_ngram_join",
    r"""
    WITH RECURSIVE d AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
    ), s AS (
        SELECT DISTINCT doc_id, w[i:i + 2] AS g
        FROM (SELECT *, unnest(range(1, greatest(len(w) - 2, CAST(len(w) > 0 AS BIGINT)) + 1)) AS i FROM d)
    ), sized AS (
        SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
    ), rare AS (
        SELECT s.doc_id, g, n, row_number() OVER (PARTITION BY s.doc_id ORDER BY f, g) AS r
        FROM s JOIN (SELECT g, count(*) AS f FROM s GROUP BY g) USING (g) JOIN sized ON sized.doc_id = s.doc_id
    ), chosen AS (
        SELECT * FROM rare WHERE r <= n - (9 * n + 9) // 10 + 1
    ), pairs AS (
        SELECT DISTINCT x.doc_id AS a, y.doc_id AS b, x.n AS an, y.n AS bn
        FROM chosen x JOIN chosen y ON x.g = y.g AND x.doc_id < y.doc_id AND 10 * least(x.n, y.n) >= 9 * greatest(x.n, y.n)
    ), links AS (
        SELECT a, b FROM pairs JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b AND y.g = x.g
        GROUP BY a, b, an, bn HAVING 100 * count(*) >= 90 * (an + bn - count(*))
    ), edges AS (
        SELECT a, b FROM links UNION ALL SELECT b, a FROM links
    ), reach(a, b) AS (
        SELECT doc_id, doc_id FROM d UNION SELECT reach.a, edges.b FROM reach JOIN edges ON edges.a = reach.b
    )
    SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, min(b) AS component_id
    FROM d LEFT JOIN sized ON sized.doc_id = d.doc_id JOIN reach ON reach.a = d.doc_id GROUP BY d.doc_id, n
    """,
)
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=90)


@query("op6_lm_score")
def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score(table(spark, sf_dir, "documents"))


@query(
    "op11_resampling",
    rf"""
    WITH shifts AS (
        SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)), lambda c, i:
               CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS tab
    ), w AS (
        SELECT 0 AS side, doc_id, row_number() OVER () AS r, {_FOLDED.format("text")} AS w FROM documents
        UNION ALL SELECT 1, NULL, row_number() OVER (), {_FOLDED.format("text")} FROM benchmark
    ), f AS (
        SELECT side, r, unnest(w) AS f FROM w
        UNION ALL SELECT side, r, w[i] || ' ' || w[i + 1] FROM (SELECT *, unnest(range(1, len(w))) AS i FROM w)
    ), hashed AS (
        SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(hex(f)), 2),
               lambda i: CAST('0x' || substr(hex(f), i, 2) AS BIGINT))),
               lambda c, b: xor(c // 256, tab[xor(c % 256, b) + 1])), 4294967295) % {resampling.BUCKETS} AS bucket
        FROM (SELECT DISTINCT f FROM f), shifts
    ), counted AS (
        SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t
        FROM f JOIN hashed USING (f) GROUP BY bucket
    ), gained AS (
        SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (sum(s) OVER () + {resampling.BUCKETS}) AS DOUBLE)
               / CAST((s + 1) * (sum(t) OVER () + {resampling.BUCKETS}) AS DOUBLE))) AS BIGINT) AS gain FROM counted
    ), weighed AS (
        SELECT r, count(*) AS n, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight
        FROM f JOIN hashed USING (f) JOIN gained USING (bucket) WHERE side = 0 GROUP BY r
    ), scored AS (
        SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
               + CAST(floor(-1000 * ln(-ln((CAST('0x' || left(sha256('7:' || doc_id), 8) AS BIGINT) + 0.5) / 4294967296)))
                      AS BIGINT) AS score, len(w) >= {resampling.MIN_WORDS} AS able
        FROM w LEFT JOIN weighed ON weighed.r = w.r WHERE side = 0
    ), placed AS (
        SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) AS p, count(*) FILTER (able) OVER () AS n
        FROM scored
    )
    SELECT doc_id, n_features, weight, score, CASE WHEN able AND p <= n * {resampling.PERCENT} // 100 THEN p END AS rank
    FROM placed
    """,
)
def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampling.importance(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


@query("op12_toxicity")
def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.find_passages(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", classifier.held_out("doc_id").alias("held_out"), "score", predicted)


@query(
    "op13_filter_audit",
    r"""
    WITH d AS (
        SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
               regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w FROM documents
    ), l AS (
        SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id
    ), f AS (
        SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, [len(w) < 100,
               100 * len(list_distinct(w)) < 80 * len(w),
               100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t),
               regexp_matches(t, '[#$%&*|]'), coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false)] AS fails
        FROM d LEFT JOIN l ON l.doc_id = d.doc_id
    ), m AS (
        SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails
    ), x AS (
        SELECT unnest(range(1, 6)) AS i
    ), o AS (
        SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
    ), s AS (
        SELECT part, o, k, fails[o[k]] AS failing, len(list_filter(fails, lambda y: y)) AS failed, n, good, toxic,
               coalesce(list_position(list_transform(o, lambda i: fails[i]), true), 9) AS place
        FROM m, o, (SELECT i AS k FROM x)
    ), r AS (
        SELECT part, o, k, coalesce(sum(n) FILTER (place > k), 0) AS kept, coalesce(sum(n) FILTER (place = k), 0) AS removed,
               coalesce(sum(n) FILTER (failing AND place < k), 0) AS redundant,
               coalesce(sum(n) FILTER (failing AND failed = 1), 0) AS unique_fails,
               coalesce(sum(good) FILTER (place = k), 0) AS good_lost, coalesce(sum(toxic) FILTER (place = k), 0) AS toxic_lost
        FROM s GROUP BY part, o, k
    )
    SELECT part, array_to_string(list_transform(o, lambda i: chr(CAST(64 + i AS INTEGER))), '') AS filter_order,
           CAST(k AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
           CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
           CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
           CAST(sum(removed) OVER (PARTITION BY part, o[k]) AS BIGINT) AS shapley
    FROM r
    """,
)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
