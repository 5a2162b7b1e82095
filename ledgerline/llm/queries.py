"""The operators on their whole tables, with production parameters, each next to its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from ledgerline.llm import chat, collocations, decontaminate, language, licenses, mixing, quality, runs, secrets, sharding, simhash, suffixes, warc
from ledgerline.llm.common import WORD

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _escaped_sql(text: str) -> str:
    """Code points after escaping: one more for each backslash and each control string."""
    added = [f"len(string_split({text}, '{c}')) - 1" for c in ["\\", *chat.Template().reserved]]
    return f"(length({text}) + {' + '.join(added)})"


_MARKERS = " ".join(f"WHEN '{role}' THEN {len(mark)}" for role, mark in chat.Template().markers)
_OP1_SQL = f"""
    WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
               UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
    e AS (SELECT *, {len("<turn>") + len("</turn>")} + {_escaped_sql("text")} +
                 CASE role {_MARKERS} ELSE {len("### Role:") + len(":###")} + {_escaped_sql("role")} END AS chars FROM c)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(chars) AS BIGINT) AS formatted_chars
    FROM e GROUP BY conv_id
"""


@query("op1_chat_formatting", _OP1_SQL)
def op1(spark: SparkSession, sf: str) -> DataFrame:
    rows = chat.with_probe(table(spark, sf, "conversations"), spark)
    return chat.read_back(chat.format_conversations(rows)).drop("n_tokens")


@query("op2_quality_rules")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return quality.with_quality(table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", "quality.*")


#: CRC-32 of short ASCII texts, as SQL: a table of the 256 remainders, then a step for each character.
_CRC_TABLE = """(SELECT list(c ORDER BY i) AS tab FROM (SELECT i, list_reduce(list_concat([i], range(8)),
    lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END) AS c FROM range(256) r(i)))"""


def _crc_sql(text: str) -> str:
    return f"""xor(4294967295, list_reduce(list_concat([4294967295], [CAST(ascii(x) AS BIGINT) for x in string_split({text}, '')]),
                   lambda x, y: xor(x // 256, tab[xor(x % 256, y) + 1])))"""


def _crc_bytes_sql(text: str) -> str:
    """The same over the UTF-8 bytes of any text, two hex digits each."""
    digits = f"hex(encode({text}))"
    return f"""xor(4294967295, list_reduce(list_concat([4294967295], [CAST('0x' || substr({digits}, 2 * i + 1, 2) AS BIGINT) for i in range(0, strlen({text}))]),
                   lambda x, y: xor(x // 256, tab[xor(x % 256, y) + 1])))"""


# The same law in one sentence: in the order of (MD5 of the text, id) a row's shard is where its middle lies among all bytes.
_OP3_SQL = f"""
    WITH k AS {_CRC_TABLE},
    d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    u AS (SELECT t, {_crc_bytes_sql("t")} AS crc FROM (SELECT DISTINCT t FROM d), k),
    s AS (SELECT doc_id, CAST(strlen(t) + 8 AS BIGINT) AS size, crc, md5(t) AS h FROM d JOIN u USING (t)),
    o AS (SELECT *, sum(size) OVER (ORDER BY h, doc_id NULLS FIRST, crc, size ROWS UNBOUNDED PRECEDING) AS stop,
                 sum(size) OVER () AS total FROM s),
    p AS (SELECT *, least(CAST(floor((stop - size / 2.0) * 24 / CAST(total AS DOUBLE)) AS INTEGER), 23) AS shard FROM o)
    SELECT doc_id, size, crc AS text_crc32, 'bytes' AS law, shard,
           row_number() OVER (PARTITION BY shard ORDER BY h, doc_id NULLS FIRST, crc, size) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
    FROM p
"""


@query("op3_sharding", _OP3_SQL)
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.shard(table(spark, sf, "documents"), 24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


_OP4_SQL = """
    WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
    w AS (SELECT doc_id, unnest([md5_number(substr(h, 2 * s + 1, 200)) for s in range(0, n - 99)]) AS k,
                 unnest(range(0, n - 99)) AS s FROM d),
    f AS (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS rn FROM w),
    g AS (SELECT doc_id, s, CASE WHEN s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) <= 100 THEN 0 ELSE 1 END AS new
          FROM f WHERE rn > 1),
    q AS (SELECT doc_id, s, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS n FROM g),
    p AS (SELECT doc_id, n AS span, min(s) AS a, max(s) + 100 AS b FROM q GROUP BY doc_id, n),
    k AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since FROM p),
    r AS (SELECT d.doc_id, sum(b - a) AS n_removed, count(*) AS n_spans,
                 string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS kept
          FROM k JOIN d USING (doc_id) GROUP BY d.doc_id)
    SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
           CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
    FROM d LEFT JOIN r USING (doc_id)
"""


@query("op4_suffix_array_dedup", _OP4_SQL)
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf, "documents")).drop("spans")


@query("op5_benchmark_decontamination")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "text")
    return decontaminate.with_matches(documents, table(spark, sf, "benchmark")).select(
        "doc_id", F.explode("matches").alias("m")
    ).select("doc_id", "m.*")


@query("op6_simhash_near_dedup")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents")).select(
        "doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id"
    )


_BASE = ("assign", "access", "hex")


def _found_sql(kind: str, turn: int, pattern: str, keep: str = "") -> str:
    """Positions of matches: all gaps and matches before them."""
    return f"""
        SELECT doc_id, {turn} AS turn, '{kind}' AS kind, s AS start, s + length(m) AS stop FROM (
            SELECT doc_id, unnest(ms) AS m, unnest(vs) AS v, unnest([
                CAST(list_sum([length(g) for g in gs[1:i]]) + coalesce(list_sum([length(x) for x in ms[1:i - 1]]), 0) AS BIGINT)
                for i in range(1, len(ms) + 1)]) AS s
            FROM (SELECT doc_id, regexp_extract_all(t, {pattern}) AS ms, regexp_extract_all(t, {pattern}, {2 if keep else 0}) AS vs,
                         string_split_regex(t, {pattern}) AS gs FROM d)) {keep}"""


_OP7_SQL = f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    f AS ({_found_sql("assign", 0, chr(39) + secrets.RULES[0].pattern.replace(chr(39), chr(39) * 2) + chr(39), "WHERE length(v) >= 6")}
        UNION ALL {_found_sql("access", 1, "'" + secrets.RULES[1].pattern + "'")}
        UNION ALL {_found_sql("hex", 2, "'" + secrets.RULES[2].pattern + "'")}
        UNION ALL {_found_sql("pem", 3, "'" + secrets.RULES[3].pattern + "'")}
        UNION ALL {_found_sql("jwt", 4, "'" + secrets.RULES[4].pattern + "'")}),
    g AS (SELECT doc_id, count(*) FILTER (turn = 0) AS n_assign, count(*) FILTER (turn = 1) AS n_access,
                 count(*) FILTER (turn = 2) AS n_hex,
                 string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, turn) FILTER (turn < 3) AS base,
                 string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, turn) AS spans
          FROM f GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN g USING (doc_id)
"""


@query("op7_secret_scans", _OP7_SQL)
def op7(spark: SparkSession, sf: str) -> DataFrame:
    versions = table(spark, sf, "documents").select("doc_id", "text")
    ledger = secrets.BlobLedger(spark)
    ledger.scan(versions)
    found = F.col("findings")
    return ledger.findings(versions).select(
        "doc_id",
        *[secrets.count_of(found, kind).alias(f"n_{kind}") for kind in _BASE],
        F.sha2(secrets.render(found, _BASE), 256).alias("base_sha256"),
        secrets.render(found).alias("spans"),
    )


_OP8_SQL = r"""
    WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                      md5('42:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS u FROM documents),
    s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                 (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM d GROUP BY source),
    c AS (SELECT *, source_size * 3 AS cap, (SELECT sum(size) FROM d) AS total,
                 row_number() OVER (ORDER BY source_size * 3 / w, source NULLS LAST) AS turn FROM s),
    k AS (SELECT a.*, (a.total - coalesce((SELECT sum(b.cap) FROM c b WHERE b.turn < a.turn), 0))
                      / (SELECT sum(b.w) FROM c b WHERE b.turn >= a.turn)::DOUBLE AS share FROM c a),
    t AS (SELECT source, source_size, CASE WHEN cap < w * share THEN CAST(cap AS DOUBLE) ELSE w * (
                 SELECT min_by(share, turn) FROM k WHERE NOT cap < w * share) END AS target FROM k),
    g AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
    o AS (SELECT d.*, source_size, target, whole, target - whole * source_size AS rest,
                 sum(size) OVER (PARTITION BY d.source ORDER BY u, doc_id, size ROWS UNBOUNDED PRECEDING) AS stop,
                 sum(size) OVER (PARTITION BY d.source, substr(u, 1, 3)) AS cell,
          FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
    e AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY substr(u, 1, 3) RANGE UNBOUNDED PRECEDING) AS cell_stop FROM o)
    SELECT doc_id, size, source_size, target, source, repeats, CAST(size * repeats AS BIGINT) AS taken FROM (
        SELECT *, whole + CASE WHEN whole >= 3 THEN 0
                               WHEN cell_stop - cell < rest AND rest < cell_stop THEN CAST(stop - size / 2.0 <= rest AS BIGINT)
                               ELSE CAST(cell_stop <= rest AS BIGINT) END AS repeats
        FROM e)
"""


@query("op8_source_mixing", _OP8_SQL)
def op8(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "source", "text")
    return mixing.with_repeats(documents).select("doc_id", "source", "mix.*")


_OP9_SQL = """
    WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
    h AS (SELECT *, sha1(body) AS h, max(page_id) OVER (PARTITION BY body) AS top FROM p)
    SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes,
           array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               CAST(((CAST('0x' || substr(h, CAST(j // 4 AS INTEGER) * 5 + 1, 5) AS INTEGER) >> (15 - (j % 4) * 5)) & 31) + 1 AS INTEGER), 1)
               for j in range(0, 32)], '') AS payload_digest,
           CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> top THEN top END AS refers_to
    FROM h
"""


@query("op9_warc_salvage", _OP9_SQL)
def op9(spark: SparkSession, sf: str) -> DataFrame:
    root = warc.write_archives(table(spark, sf, "pages"))
    back = warc.read_archives(spark, root, with_payload=False)
    return back.where("kind = 'record'").select(
        F.col("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


@query("op10_language_id")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "text", "lang").withColumn("held_out", language.held_out("doc_id"))
    model = language.fit(documents.where(~F.col("held_out")), "text", "lang", "doc_id")
    labelled = language.with_language(documents.select("doc_id", "held_out", "text"), model, spans=False)
    return labelled.select("doc_id", "held_out", "language.lang_pred", "language.score")


def _rules_sql() -> str:
    spelled = ", ".join(
        f"({k}, '{r.label}', '{r.pattern}', {r.priority}, CAST({r.confidence} AS DOUBLE), {r.base})" for k, r in enumerate(licenses.RULES)
    )
    return f"(VALUES {spelled}) r(rule, label, pattern, priority, confidence, base)"


def _words_sql(stretch: str) -> str:
    return f"((length({stretch}) - length(replace({stretch}, ' ', ''))) // 2)"


# Every rule is tried on every text that one expression of all of them finds something in: no keywords here.
_OP11_SQL = rf"""
    WITH d AS (SELECT doc_id, trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '{licenses.SEPARATOR}', '  ', 'g'), ' ') AS t FROM documents),
    n AS (SELECT doc_id, CASE WHEN t = '' THEN '' ELSE ' ' || t || ' ' END AS t FROM d),
    m AS (SELECT doc_id, rule, label, priority, confidence, base, string_split_regex(t, pattern) AS gs, regexp_extract_all(t, pattern) AS ms
          FROM n, {_rules_sql()} WHERE regexp_matches(t, pattern)),
    w AS (SELECT *, [{_words_sql("x")} for x in gs] AS gaps, [{_words_sql("x")} for x in ms] AS sizes FROM m),
    f AS (SELECT doc_id, rule, label, priority, confidence, base,
                 unnest([CAST(list_sum(gaps[1:i]) + coalesce(list_sum(sizes[1:i - 1]), 0) AS BIGINT) for i in range(1, len(ms) + 1)]) AS s,
                 unnest(sizes) AS k FROM w),
    e AS (SELECT *, s + k AS e FROM f),
    stay AS (SELECT * FROM e WHERE base OR NOT EXISTS (
        SELECT 1 FROM e o WHERE o.doc_id = e.doc_id AND o.s <= e.s AND o.e >= e.e AND o.priority <= e.priority
            AND (o.k > e.k OR o.priority < e.priority OR (o.priority = e.priority AND o.rule < e.rule)))),
    g AS (SELECT doc_id, count(*) FILTER (base) AS n_base, min(s) FILTER (base) AS first_word, max(s) FILTER (base) AS last_word,
                 string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
                 string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(confidence) AS score FROM stay GROUP BY doc_id)
    SELECT n.doc_id, CAST({_words_sql("t")} AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
           coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score
    FROM n LEFT JOIN g USING (doc_id)
"""


@query("op11_license_scans", _OP11_SQL)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    found = licenses.with_licenses(table(spark, sf, "documents").select("doc_id", "text"))
    base = F.filter("licenses.detections", lambda d: d["base"])
    starts = F.transform(base, lambda d: d["start"].cast("long"))
    return found.select(
        "doc_id",
        "licenses.n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(base, lambda d: d["label"]))), ",").alias("base_labels"),
        F.array_join("licenses.labels", ",").alias("labels"),
        "licenses.score",
    )


_OP12_SQL = r"""
    WITH d AS (SELECT doc_id, coalesce(lang, 'und') AS lang,
                      unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
    t AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
    o AS (SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') for i in range(1, len(w) - k + 2)]) AS phrase
          FROM w, range(1, 5) r(k) WHERE len(w) >= k),
    f AS (SELECT lang, k, phrase, count(*) AS f FROM o GROUP BY ALL),
    c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 30),
    x AS (SELECT lang, phrase, k, a, unnest(range(1, k)) AS cut, w FROM c),
    s AS (SELECT x.lang, x.phrase, x.a, x.cut, l.f AS l, r.f AS r, CAST(2000000 AS HUGEINT) * x.a // (CAST(l.f AS HUGEINT) + r.f) AS score
          FROM x JOIN f l ON l.lang = x.lang AND l.phrase = array_to_string(w[1:cut], ' ')
                 JOIN f r ON r.lang = x.lang AND r.phrase = array_to_string(w[cut + 1:], ' ')),
    b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
    p AS (SELECT c.lang, c.a, array_to_string(w[i:i + m - 1], ' ') AS phrase
          FROM c, range(2, 4) q(m), range(1, 4) j(i) WHERE m < k AND i + m - 1 <= k),
    g AS (SELECT lang, phrase, max(a) AS longer FROM p GROUP BY lang, phrase),
    z AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(b.phrase)) AS rank
          FROM b LEFT JOIN g USING (lang, phrase)
          WHERE longer IS NULL OR CAST(100 AS HUGEINT) * longer < CAST(80 AS HUGEINT) * a)
    SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM z JOIN t USING (lang) WHERE rank <= 2000
"""


@query("op12_phrase_collocations", _OP12_SQL)
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(table(spark, sf, "documents"))


# A run's words repeat over 16 words or more a period later, so pairs of equal stretches of 16 words hold all runs.
_OP13_SQL = rf"""
    WITH k AS {_CRC_TABLE},
    d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
                 coalesce({_crc_sql("CAST(doc_id AS VARCHAR)")}, 1) AS h FROM documents, k),
    g AS (SELECT *, len(w) AS n, h // 10 AS g FROM d),
    a AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS a FROM g),
    p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
    t AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
                 THEN [w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1] for i in range(n)] ELSE w END AS w FROM p),
    s AS (SELECT doc_id, unnest(range(0, n - 15)) AS i,
                 unnest([md5_number(array_to_string(w[i + 1:i + 16], ' ')) for i in range(0, n - 15)]) AS x FROM t),
    e AS (SELECT a.doc_id, a.i, b.i - a.i AS q FROM s a JOIN s b ON a.doc_id = b.doc_id AND a.x = b.x AND b.i > a.i),
    f AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM e),
    r AS (SELECT doc_id, q, min(i) AS s, count(*) + 15 + q AS l FROM f GROUP BY doc_id, q, island),
    m AS (SELECT doc_id, s, l, min(q) AS q FROM r WHERE l >= greatest(24, 3 * q) GROUP BY doc_id, s, l),
    gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM m),
    x AS (SELECT doc_id, unnest(range(n)) AS i, unnest(w) AS w FROM t),
    y AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS kept FROM x ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
    b AS (SELECT doc_id, count(*) AS n_runs, arg_min({{'s': s, 'l': l, 'q': q}}, (-l / CAST(q AS DOUBLE), s, q)) AS best,
                 string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS listed FROM m GROUP BY doc_id)
    SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.q AS period,
           best.l * 1000 // best.q AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256,
           sha256(coalesce(kept, '')) AS collapsed_sha256
    FROM t LEFT JOIN b USING (doc_id) LEFT JOIN y USING (doc_id)
"""


@query("op13_run_detection", _OP13_SQL)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    key = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = table(spark, sf, "documents").select("doc_id", F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), 0).alias("words"))
    planted = words.select("doc_id", F.array_join(runs.with_planted_run(F.col("words"), key), " ").alias("text"))
    best = F.col("periodic.strongest")
    return runs.with_runs(planted).select(
        "doc_id",
        F.size("periodic.runs").cast("long").alias("n_runs"),
        *[best[name].alias(name) for name in ("start", "length", "period")],
        F.floor(best["length"] * 1000 / best["period"]).alias("exponent_milli"),
        F.sha2(runs.listed(F.col("periodic.runs")), 256).alias("runs_sha256"),
        F.sha2("periodic.collapsed", 256).alias("collapsed_sha256"),
    )


@query("pipeline")
def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf)
