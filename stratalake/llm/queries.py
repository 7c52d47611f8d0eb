"""The registered queries of the corpus operators, with their check SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import decontam, exact_dedup, language, licenses, mixing, periodic, prefix_trie, quality, repeats, simhash, tokens, toxicity, warc
from stratalake.llm.common import WORD, staged, table
from stratalake.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op2_simhash")
def op2(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("row_key", F.monotonically_increasing_id())
    # The fingerprints are stored before anything else reads the row key.
    return simhash.near_groups(docs, "row_key").select("doc_id", "fingerprint", "component_id")


_MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    ('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, '')) || ':'
      || (row_number() OVER (PARTITION BY doc_id, coalesce(text, ''), source) - 1)), 1, 13))::BIGINT AS draw
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
r AS (SELECT *, 2 * source_size AS cap, (2 * source_size) / weight::DOUBLE AS reach FROM w),
lv AS (SELECT *, row_number() OVER o AS n,
    (1.5::DOUBLE * CAST(sum(source_size) OVER () AS BIGINT)
      - CAST(coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT))
      / CAST(sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS level
  FROM r WINDOW o AS (ORDER BY reach, source NULLS LAST)),
f AS (SELECT arg_min(level, n) AS level FROM lv WHERE level <= reach),
t AS (SELECT source, source_size, coalesce(least(cap::DOUBLE, f.level * weight), cap::DOUBLE) AS target FROM lv LEFT JOIN f ON true),
p AS (SELECT t.*, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
q AS (SELECT p.*, target - whole * source_size AS rest FROM p),
g AS (SELECT d.source, size, count(*) AS n, any_value(rest) AS rest FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source
  WHERE size > 0 AND rest > 0 GROUP BY d.source, size),
gl AS (SELECT source, size, (rest - coalesce(sum(size * n) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(n * size * sqrt(size)) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS scale
  FROM g WINDOW o AS (PARTITION BY source ORDER BY size DESC)),
sc AS (SELECT source, arg_max(scale, size) AS scale FROM gl WHERE scale * sqrt(size) < 1 GROUP BY source),
k AS (SELECT d.*, q.source_size, q.target, q.whole, q.rest, (d.draw + 0.5) / 4503599627370496.0::DOUBLE AS u, sc.scale * sqrt(size) AS incl
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source LEFT JOIN sc ON d.source IS NOT DISTINCT FROM sc.source),
x AS (SELECT *, CASE WHEN incl < 1 THEN (u / (1 - u)) / (incl / (1 - incl)) END AS ratio FROM k),
y AS (SELECT *, CASE WHEN incl >= 1 THEN 0 ELSE ratio / (1 + ratio) END AS rank, size > 0 AND rest > 0 AS drawable FROM x),
c1 AS (SELECT *, sum(size) OVER (PARTITION BY source, drawable ORDER BY rank, draw, size) AS cum FROM y),
z1 AS (SELECT *, drawable AND cum <= rest AS taken1,
    rest - coalesce(max(CASE WHEN drawable AND cum <= rest THEN cum END) OVER (PARTITION BY source), 0) AS open,
    max(CASE WHEN drawable AND cum > rest THEN 1 ELSE 0 END) OVER (PARTITION BY source) AS over_any,
    min(CASE WHEN drawable AND cum > rest THEN cum END) OVER (PARTITION BY source) AS over_cum FROM c1),
c2 AS (SELECT *, drawable AND over_any = 1 AND cum > over_cum AND size <= open AS late FROM z1),
z2 AS (SELECT *, CASE WHEN late THEN sum(size) OVER (PARTITION BY source, late ORDER BY rank, draw, size) END AS cum2 FROM c2),
e AS (SELECT *, whole + CASE WHEN taken1 OR coalesce(cum2 <= open, false) THEN 1 ELSE 0 END AS copies FROM z2)
SELECT doc_id, source, CAST(size AS BIGINT) AS size, source_size, target, CAST(copies AS BIGINT) AS copies,
  CAST(copies * size AS BIGINT) AS taken FROM e
"""


@query("op4_pareto_mix", _MIX_SQL)
def op4(spark, sf_dir):
    rows = staged(mixing.sized_rows(table(spark, sf_dir, "documents")), "mix-rows")
    return mixing.mixed(rows)


@query(
    "op6_exact_dedup",
    r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS body, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(body) DESC, doc_id NULLS LAST) AS keep_id,
  count(*) OVER (PARTITION BY norm) AS group_size,
  row_number() OVER (PARTITION BY norm ORDER BY length(body) DESC, doc_id NULLS LAST) = 1 AS kept, sha256(norm) AS text_sha256 FROM d
""",
)
def op6(spark, sf_dir):
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op9_token_counts")
def op9(spark, sf_dir):
    import public_tokenizers

    return tokens.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op10_language")
def op10(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"))


@query("op3_quality")
def op3(spark, sf_dir):
    return quality.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_toxicity")
def op8(spark, sf_dir):
    return toxicity.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(
    "op1_warc",
    r"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
    coalesce(html, '') AS body, url FROM pages),
m AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY body) END AS first FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to, url AS target_uri FROM m
""",
)
def op1(spark, sf_dir):
    path = scratch_path(spark, "warc")
    warc.write_warc(warc.page_records(table(spark, sf_dir, "pages")), path)
    columns = ["record_id", "record_type", "target_uri", "payload_digest", "payload_length", "headers", "payload"]
    return warc.page_facts(warc.read_warc(spark, path, columns)).drop("record_id")


def _license_sql() -> str:
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    known = licenses.known_of(licenses.SENTENCES)
    table = lambda found: "MAP {" + ", ".join(f"{quote(k)}: {quote(v)}" for k, v in found.items()) + "}"
    each = lambda column, pattern, by: f"regexp_replace({column}, {quote(pattern)}, {by}, 'g')"
    cut = each("translate(" + each("coalesce(text, '')", licenses.WRAPPED, "' \\1'") + ", chr(12), ' ')", licenses.MARK, "''")
    cut = each(f"lower({each(cut, licenses.STOP.replace('(?<=[.!?])', '([.!?])'), "chr(92) || '1' || chr(12)")})", licenses.NOISE, "' '")
    cut = f"trim({each(each(cut, licenses.LINES, 'chr(10)'), licenses.STOPS, 'chr(12)')}, ' ')"
    for one, two in licenses.DOUBLED:
        cut = f"replace({cut}, {quote(one)}, {quote(two)})"
    line = "coalesce(array_to_string(list_transform(ids, lambda x: '|' || x || '|'), ''), '')"
    for licence, needed in licenses.RULES:
        line = f"replace({line}, {quote('|' + '||'.join(needed) + '|')}, {quote('<' + licence + '>')})"
    return rf"""
WITH plain AS (SELECT doc_id, chr(10) || {cut} || chr(10) AS body FROM documents),
said AS (SELECT doc_id, list_transform(regexp_extract_all(body, {quote(licenses.pattern_of(known))}),
  lambda s: trim(regexp_replace(s, '[\x20\n]+', ' ', 'g'))) AS parts FROM plain),
named AS (SELECT doc_id, list_transform(parts,
  lambda s: coalesce({table(known)}[s], {table(licenses.names_of())}[regexp_replace(s, {quote("^" + licenses.LEAD)}, '')])) AS ids FROM said),
lined AS (SELECT doc_id, ids, {line} AS line FROM named),
found AS (SELECT doc_id, ids, line, regexp_extract_all(line, '<([^>]*)>', 1) AS raw FROM lined),
firsts AS (SELECT *, list_filter(raw, lambda x, i: list_position(raw, x) = i) AS licences FROM found)
SELECT doc_id, coalesce(array_to_string(ids, ','), '') AS sentence_ids, coalesce(array_to_string(licences, ','), '') AS licences,
  CASE len(licences) WHEN 0 THEN 'none' WHEN 1 THEN licences[1] ELSE 'several' END AS licence,
  coalesce(array_to_string(regexp_extract_all(line, '\|([^|]*)\|', 1), ','), '') AS unmatched FROM firsts
"""


@query("op7_license_scan", _license_sql())
def op7(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op5_decontamination")
def op5(spark, sf_dir):
    found = decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("key", "doc_id")


def _planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): documents whose id hashes to a multiple of ten repeat a part of their words."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})"))).alias("words"))
    sized = words.withColumn("n", F.size("words")).withColumn("g", F.floor(F.col("h") / 10))
    cut = sized.withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int")))
    cut = cut.withColumn("p", (1 + F.expr("(n - a) div (3 + g % 8)")).cast("int"))
    repeated = F.expr("array_join(transform(sequence(0, n - 1), i -> words[if(i < a, i, a + (i - a) % p)]), ' ')")
    return cut.select("doc_id", F.when(F.col("a").isNotNull(), repeated).otherwise(F.col("text")).alias("text"))


@query("op11_periodic_runs")
def op11(spark, sf_dir):
    found = periodic.find_runs(_planted_periods(table(spark, sf_dir, "documents")))
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    # Runs come by start, then period: of equal exponents the first stays.
    best = F.expr(
        f"aggregate(runs, CAST(NULL AS {periodic.RUN}), (b, r) -> if(b IS NULL OR r.length * b.period > b.length * r.period, r, b))"
    )
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), lines.alias("lines"), "collapsed").select(
        "doc_id",
        "n_runs",
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op12_substring_dedup")
def op12(spark, sf_dir):
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def _rebuilt(paths: DataFrame) -> DataFrame:
    """Conversations whose first turns are those of the first conversation of their five."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    base = F.col("conv_id") - F.col("conv_id") % 5
    heads = paths.where(F.col("conv_id") == base).select(F.col("conv_id").alias("base"), F.slice("turns", 1, 8).alias("head"))
    rows = paths.select("conv_id", "turns", base.alias("base"), h.alias("h")).join(heads, "base", "left")
    head = F.when(F.col("head").isNotNull(), F.expr("slice(head, 1, h)")).otherwise(F.expr("slice(turns, 1, 0)"))
    return rows.select("conv_id", F.concat(head, F.expr("slice(turns, h + 1, size(turns))")).alias("turns"))


@query(
    "op13_prefix_trie",
    """
WITH t AS (SELECT conv_id, turn, md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS mark,
    octet_length(encode(coalesce(text, ''))) AS bytes FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list(mark ORDER BY turn NULLS FIRST, mark) AS marks, list(bytes ORDER BY turn NULLS FIRST, mark) AS sizes,
    xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, 3988292384 * (v & 1))))) % 9 AS h
  FROM t GROUP BY conv_id),
r AS (SELECT o.conv_id, list_concat(coalesce(b.marks[1:o.h], []), o.marks[o.h + 1:]) AS marks, list_concat(coalesce(b.sizes[1:o.h], []), o.sizes[o.h + 1:]) AS sizes
  FROM o LEFT JOIN o b ON b.conv_id = o.conv_id - o.conv_id % 5),
p AS (SELECT conv_id, d, array_to_string(marks[1:d], '') AS key, len(marks) = d AS ends, CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS bytes
  FROM (SELECT *, unnest(range(0, len(marks) + 1)) AS d FROM r)),
n AS (SELECT key, d, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256 FROM p GROUP BY key, d),
c AS (SELECT key[1:32 * (d - 1)] AS key, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
w AS (SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM n LEFT JOIN c ON n.key = c.key),
a AS (SELECT key[1:32 * k] AS key, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * bytes) AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM w) GROUP BY 1)
SELECT w.conv_id, CAST(w.d AS BIGINT) AS depth, q.conv_id AS parent_conv_id, w.n_convs, w.n_children, a.n_leaves, CAST(a.saved_tokens AS BIGINT) AS saved_tokens, w.ends_sha256
FROM w JOIN a ON w.key = a.key LEFT JOIN n q ON w.d > 0 AND q.key = w.key[1:32 * (w.d - 1)]
""",
)
def op13(spark, sf_dir):
    return prefix_trie.prefix_nodes(_rebuilt(prefix_trie.paths_of(table(spark, sf_dir, "conversations"))))
