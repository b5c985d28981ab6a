"""One query for each operator, over its whole table, with the SQL it is compared to where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    decontamination, html, licenses, mixing, neighbours, ngram_join, phrases, pii, quality_lines, repeats, tool_calls, url_lists, vector_codes,
)
from millrace.session import load_table


def _texts(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return load_table(spark, folder, "documents").select("doc_id", "text", *columns)


def main_texts(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    found = html.extract(load_table(spark, folder, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def listed_captures(spark: SparkSession, folder: str) -> DataFrame:
    """Every page as a capture of the day its number names, against a list that logs a part of the pages' hosts.

    By the first byte of its md5 a host is listed as a domain (below 100) or by its first path segments
    (100 to 159): for the first time in the first half of the year, off again after 40 days or more, and for
    a third of them on again 60 days after that.
    """
    pages = load_table(spark, folder, "pages").select("page_id", "url")
    site = url_lists.host("url")
    byte = F.conv(F.substring(F.md5("host"), 1, 2), 16, 10).cast("int")
    second = F.conv(F.substring(F.md5("host"), 3, 2), 16, 10).cast("int")
    segment = F.regexp_extract("url", r"^[a-z]+://[^/?#]+/([^/?#]+)", 1)
    keys = pages.select(site.alias("host"), segment.alias("segment")).filter("host <> ''").distinct()
    keys = keys.withColumn("byte", byte).withColumn("second", second)
    listed = keys.filter("byte < 100").select(F.lit("domain").alias("kind"), F.col("host").alias("key"), "byte", "second").distinct().unionByName(
        keys.filter("byte between 100 and 159 and segment <> ''").select(F.lit("prefix").alias("kind"), F.concat_ws("/", "host", "segment").alias("key"), "byte", "second"))
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("byte"))
    off = F.date_add(day, 40 + F.col("second"))
    again = F.when(F.col("second") % 3 == 0, F.date_add(off, 60))
    entry = lambda on, action: F.struct(on.alias("listed_on"), F.lit(action).alias("action"))
    log = listed.select("kind", "key", F.inline(F.array(entry(day, "add"), entry(off, "remove"), entry(again, "add"))))
    captures = pages.withColumn("fetched_on", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 366).cast("int")))
    found = url_lists.judge(captures, log)
    return found.select("page_id", "url", F.col("fetched_on").cast("string").alias("fetched_on"), F.size("matches").cast("long").alias("n_matches"),
                        F.array_join("matches", ",").alias("matches"), (F.size("matches") > 0).alias("blocked"))


LISTED_SQL = r"""
WITH captures AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(page_id % 366 AS INTEGER) AS fetched_on,
         regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+?)\.?(?:[:/?#]|$)', 1) AS host,
         regexp_extract(url, '^[a-z]+://[^/?#]+/([^/?#]+)', 1) AS segment
  FROM pages
), hosts AS (
  SELECT DISTINCT host, segment, md5(host) AS h FROM captures WHERE host <> ''
), bytes AS (
  SELECT host, segment,
         16 * (instr('0123456789abcdef', h[1]) - 1) + instr('0123456789abcdef', h[2]) - 1 AS b,
         16 * (instr('0123456789abcdef', h[3]) - 1) + instr('0123456789abcdef', h[4]) - 1 AS s
  FROM hosts
), listed AS (
  SELECT DISTINCT 'domain' AS kind, host AS key, b, s FROM bytes WHERE b < 100
  UNION ALL SELECT DISTINCT 'prefix', host || '/' || segment, b, s FROM bytes WHERE b BETWEEN 100 AND 159 AND segment <> ''
), days AS (
  SELECT kind, key, s, DATE '2024-01-01' + CAST(b AS INTEGER) AS first, DATE '2024-01-01' + CAST(b + 40 + s AS INTEGER) AS until FROM listed
), spans AS (
  SELECT kind, key, first, until FROM days
  UNION ALL SELECT kind, key, until + 60, NULL FROM days WHERE s % 3 = 0
), found AS (
  SELECT c.page_id, l.kind || ':' || l.key AS entry
  FROM captures c JOIN spans l
    ON ((l.kind = 'domain' AND (c.host = l.key OR ends_with(c.host, '.' || l.key)))
        OR (l.kind = 'prefix' AND c.host || '/' || c.segment = l.key))
   AND l.first <= c.fetched_on AND (l.until IS NULL OR c.fetched_on < l.until)
), lists AS (
  SELECT page_id, count(DISTINCT entry) AS n, string_agg(DISTINCT entry, ',' ORDER BY entry) AS entries FROM found GROUP BY page_id
)
SELECT c.page_id, c.url, CAST(c.fetched_on AS VARCHAR) AS fetched_on, coalesce(n, 0) AS n_matches, coalesce(entries, '') AS matches, n IS NOT NULL AS blocked
FROM captures c LEFT JOIN lists USING (page_id)
"""


def personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of personal data of every document."""
    found = pii.mark(_texts(spark, folder))
    base = F.filter("pii", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    kinds = F.transform("pii", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, (lambda kind: lambda k: k == kind)(kind))).cast("long").alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.listed(base), 256).alias("base_sha256"), pii.listed(F.col("pii")).alias("spans"))


def source_mix(spark: SparkSession, folder: str) -> DataFrame:
    """How many words of every document the mix takes."""
    sized = load_table(spark, folder, "documents").select("doc_id", "source", mixing.words().alias("size"))
    return mixing.mix(sized).select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of the base rules and the verdict on every document."""
    texts = _texts(spark, folder)
    model = quality_lines.fit(texts, load_table(spark, folder, "labels"))
    return quality_lines.label_documents(texts, model).select("doc_id", "quality_lines.*")


def jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Size of every document's shingle set and the smallest document that links reach."""
    return ngram_join.join(_texts(spark, folder)).select("doc_id", "n_shingles", "component_id")


def linked_calls(spark: SparkSession, folder: str) -> DataFrame:
    """The turns of all conversations as tool calls: what a user says calls ``answer``, a system turn ``configure``.

    The turn that follows an ``answer`` is its result; a call comes after the one two turns before.
    """
    turns = load_table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").filter("conv_id is not null and turn is not null")
    number = lambda back: F.concat_ws(":", "conv_id", F.col("turn") - back)
    calls = turns.filter("role in ('user', 'system')").select(
        "conv_id", number(0).alias("call_id"), F.when(F.col("role") == "user", "answer").otherwise("configure").alias("name"),
        F.to_json(F.struct("turn", "text", F.length("text").alias("chars"))).alias("arguments"),
        F.when(F.col("turn") >= 2, number(2)).alias("after"))
    results = turns.filter("role = 'assistant'").select("conv_id", number(1).alias("call_id"), F.col("text").alias("output"))
    fields = [("answer", "text", "string", True), ("answer", "turn", "integer", True), ("answer", "chars", "integer", False),
              ("configure", "text", "string", True), ("configure", "turn", "integer", True), ("configure", "chars", "integer", False)]
    schemas = spark.createDataFrame(fields, "name string, field string, type string, required boolean")
    found = tool_calls.link(calls, results, schemas)
    return found.select("conv_id", "call_id", "name", "level", "n_rows", "n_results", "n_outputs", "dangling", F.array_join("problems", ",").alias("problems"), "valid", "json")


def quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Score of every document by its labelled neighbours; documents of remainder 0 are held out."""
    texts = _texts(spark, folder)
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = neighbours.fit(texts, load_table(spark, folder, "labels"), ~held_out)
    found = neighbours.score(texts, model)
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= neighbours.THRESHOLD).cast("int").alias("predicted"))


def repeated_strings(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without strings that occur elsewhere."""
    found = repeats.remove(_texts(spark, folder))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return found.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), "kept_sha256")


def benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that lie in windows of benchmark items."""
    found = decontamination.judge(_texts(spark, folder), load_table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The 2,000 phrases of every language whose words go together most."""
    found = phrases.collocations(load_table(spark, folder, "documents"))
    return found.withColumnRenamed("group", "lang")


def vector_compression(spark: SparkSession, folder: str) -> DataFrame:
    """Code and error of every usable vector, and the codebooks they are of."""
    found = vector_codes.compress(load_table(spark, folder, "embeddings"))
    return found.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def _codes_sql(parts: int, entries: int, rounds: int, scale: int) -> str:
    """The fit as one query: ``books0`` holds the first entries, ``booksN`` those after N rounds."""
    steps = [f"""
WITH RECURSIVE usable AS (
  SELECT vec_id, label, [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), rows_numbered AS (
  SELECT *, row_number() OVER (ORDER BY vec_id) AS row_no, len(v) // {parts} AS width FROM usable
), parts AS MATERIALIZED (
  SELECT row_no, p, v[p * width + 1:(p + 1) * width] AS part FROM rows_numbered, range({parts}) AS every(p)
), books0 AS MATERIALIZED (
  SELECT p, row_no - 1 AS e, part AS entry FROM parts WHERE row_no <= {entries}
)"""]
    for i in range(rounds + 1):
        steps.append(f""", near{i} AS MATERIALIZED (
  SELECT row_no, p, part, unnest(best) FROM (
    SELECT row_no, p, any_value(part) AS part, arg_min({{'e': e, 'd': d}}, {{'d': d, 'e': e}}) AS best FROM (
      SELECT row_no, a.p, part, e, list_sum([(a.part[i] - b.entry[i]) * (a.part[i] - b.entry[i]) FOR i IN range(1, len(a.part) + 1)]) AS d
      FROM parts AS a JOIN books{i} AS b ON a.p = b.p
    ) GROUP BY row_no, p)
)""")
        if i < rounds:
            steps.append(f""", sums{i} AS (
  SELECT p, e, i, CAST(sum(part[i]) AS HUGEINT) AS s, count(*) AS n
  FROM (SELECT p, e, part, unnest(range(1, len(part) + 1)) AS i FROM near{i}) GROUP BY p, e, i
), means{i} AS (
  SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS entry FROM sums{i} GROUP BY p, e
), books{i + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.entry, b.entry) AS entry FROM books{i} AS b LEFT JOIN means{i} AS m ON m.p = b.p AND m.e = b.e
)""")
    steps.append(f""", coded AS (
  SELECT row_no, string_agg(lpad(lower(hex(e)), 2, '0'), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{rounds} GROUP BY row_no
), digest AS (
  SELECT sha256(string_agg(array_to_string(entry, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM books{rounds}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM rows_numbered JOIN coded USING (row_no), digest
""")
    return "".join(steps)


CODES_SQL = _codes_sql(vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.ROUNDS, vector_codes.SCALE)


def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licence phrases and notices of every document."""
    found = licenses.scan(_texts(spark, folder))
    base = F.filter("licenses", lambda s: s["base"])
    starts = F.transform(base, lambda s: s["start"])
    listed = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    score = F.coalesce(F.array_max(F.transform("licenses", lambda s: s["score"])), F.lit(0.0))
    return found.select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                        listed(base).alias("base_labels"), listed(F.col("licenses")).alias("labels"), score.alias("score"))


COLLOCATIONS_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM pieces
), places AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded
), found AS (
  SELECT lang, s AS size, array_to_string(w[i:i + s - 1], ' ') AS phrase
  FROM places, (VALUES (1), (2), (3), (4)) AS sizes(s) WHERE i + s - 1 <= len(w)
), every AS (
  SELECT lang, size, phrase, CAST(count(*) AS BIGINT) AS f FROM found GROUP BY ALL
), totals AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM every WHERE size = 1 GROUP BY lang
), frequent AS (
  SELECT lang, size, phrase, f, string_split(phrase, ' ') AS w FROM every WHERE f >= 30
), cuts AS (
  SELECT c.lang, c.size, c.phrase, c.f AS a, k, l.f AS l, r.f AS r,
         CAST(2000000 * CAST(c.f AS HUGEINT) // (CAST(l.f AS HUGEINT) + r.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM frequent WHERE size >= 2) AS c
  JOIN frequent AS l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
  JOIN frequent AS r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')
), weakest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_phrases AS (
  SELECT lang, f, array_to_string(w[i:j], ' ') AS phrase
  FROM (SELECT *, unnest(range(i + 1, size + 1)) AS j FROM (SELECT *, unnest(range(1, size)) AS i FROM frequent WHERE size >= 3))
  WHERE j - i + 1 < size
), longest AS (
  SELECT lang, phrase, max(f) AS f FROM inner_phrases GROUP BY ALL
), kept AS (
  SELECT c.lang, c.phrase, c.a, c.l, c.r, c.score FROM weakest AS c LEFT JOIN longest AS g ON g.lang = c.lang AND g.phrase = c.phrase
  WHERE g.f IS NULL OR 100 * CAST(g.f AS HUGEINT) < 80 * CAST(c.a AS HUGEINT)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


#: Name: the query, and its SQL or None.
QUERIES = {
    "op1_main_text": (main_texts, None),
    "op2_listed_captures": (listed_captures, LISTED_SQL),
    "op3_personal_data": (personal_data, None),
    "op4_source_mix": (source_mix, None),
    "op5_quality_rules": (quality_rules, None),
    "op6_ngram_join": (jaccard_join, None),
    "op7_linked_calls": (linked_calls, None),
    "op8_quality_scores": (quality_scores, None),
    "op9_benchmark_leaks": (benchmark_leaks, None),
    "op10_repeated_strings": (repeated_strings, None),
    "op11_vector_codes": (vector_compression, CODES_SQL),
    "op12_license_scan": (license_scan, None),
    "op13_phrase_collocations": (phrase_collocations, COLLOCATIONS_SQL),
}
