"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.llm import (conversation_trie, decontaminate, hard_negatives, langid, license_scan, line_dedup,
                           packing, quality, quality_classifier, simhash, substring_dedup, suffix_dedup, url_filter)
from spendlens.sources.tables import read_table

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers
    return str(public_tokenizers.path(TOKENIZER))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), tokenizer_path())
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                      "sequence_id", "offset")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.dedup_substrings(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return out.select("row.doc_id", "kept.n_words", "kept.n_removed", F.sha2("kept.text", 256).alias("kept_sha256"))


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.simhash_groups(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages", ["page_id", "url", "html"])
    out = url_filter.filter_urls(pages.select("page_id", "url"), url_filter.junk_listing(pages))
    return out.select("page_id", "host", "path", "rule", "verdict")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.scan_benchmark(read_table(spark, sf_dir, "documents", ["doc_id", "text"]),
                                       read_table(spark, sf_dir, "benchmark"))
    return out.select("row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.dedup_bytes(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return out.select("row.doc_id", "kept.n_bytes", "kept.n_removed", "kept.n_spans",
                      F.sha2("kept.text", 256).alias("kept_sha256"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.judge_quality(read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"]))
    return out.drop("char_distance", "word_distance", "word_limit")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = langid.identify_language(read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"]))
    return out.select("row.doc_id", "held_out", "lang_pred", "score", "rejected")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return out.select("row.doc_id", "kept.n_lines", "kept.n_dropped", F.sha2("kept.text", 256).alias("kept_sha256"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.conversation_trie(
        read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"]))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings", ["vec_id", "label", "embedding"])
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors.withColumn("label", moved))


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify_quality(read_table(spark, sf_dir, "documents", ["doc_id", "text"]),
                                               read_table(spark, sf_dir, "labels", ["doc_id", "quality"]))


QUERIES = {f.__name__: f for f in (
    op1_packing, op2_substring_dedup, op3_simhash_dedup, op4_url_filter, op5_license_scan,
    op6_decontaminate, op7_suffix_dedup, op8_quality_rules, op9_language_id, op10_line_dedup,
    op11_conversation_trie, op12_hard_negatives, op13_quality_classifier)}

_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_NORMAL = (r"regexp_extract_all(translate(coalesce(text, ''), " + _LOWER
           + r"), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


def _quality_sql() -> str:
    """The base rules and both Jensen-Shannon distances, written out for DuckDB."""
    classes = ["a-z", "A-Z", "0-9", r"\x20\x09-\x0D", r".,;:!?''\"()\-", "#*$%&|<>"]
    only = ", ".join(f"length(regexp_replace(t, '[^{c}]+', '', 'g'))" for c in classes)
    vocabulary = sorted({w for own in quality.COMMON_WORDS.values() for w in own})
    listed = "[" + ", ".join(f"'{w}'" for w in vocabulary) + "]"
    capital = "upper(v[1]) || v[2:]"
    nc, nw = len(classes) + 1, len(vocabulary) + 1
    langs = ", ".join(f"'{x}'" for x in quality.COMMON_WORDS)

    def share(x, n):
        return f"list_transform({x}, lambda z: z / greatest(list_sum({x}), 1e-300))"

    def half(x, y):
        return f"CASE WHEN {x} > 0 THEN {x} * log2({x} / (({x} + {y}) / 2)) ELSE 0 END"

    def distance(p, q, n):
        return (f"sqrt(greatest(list_sum(list_transform(range(1, {n} + 1), lambda i: "
                f"{half(f'{p}[i]', f'{q}[i]')} + {half(f'{q}[i]', f'{p}[i]')})) / 2, 0))")

    sums = [", ".join(f"CAST(sum({c}[{i}]) AS DOUBLE)" for i in range(1, n + 1)) for c, n in (("cc", nc), ("ww", nw))]
    return f"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS k
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5) x),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM
      (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS c FROM g) y WHERE c > 1) z GROUP BY 1),
m AS (SELECT doc_id, lang, len(w) AS n_words, list_sum(list_transform(w, lambda x: length(x))) AS word_chars,
      length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
      len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))
      - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))) AS n_dup_lines,
      coalesce(r.n, 0) AS n_repeat_words, [{only}] AS seen, length(t) AS n_chars,
      list_transform({listed}, lambda v: len(list_filter(w, lambda x: x = v OR x = {capital}))) AS found
      FROM d LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
      list_append(seen, n_chars - list_sum(seen)) AS cc, list_append(found, n_words - list_sum(found)) AS ww FROM m),
s AS (SELECT lang, [{sums[0]}] AS sc, [{sums[1]}] AS sw FROM b
      WHERE NOT base_failed AND n_words >= 50 GROUP BY lang),
q AS (SELECT lang, {share('sc', nc)} AS qc, CASE WHEN lang IN ({langs}) THEN {share('sw', nw)} END AS qw FROM s),
l AS (SELECT *, [CASE WHEN i = {nw} THEN 1.0::DOUBLE ELSE 0 END FOR i IN range(1, {nw} + 1)] AS none FROM q),
lim AS (SELECT lang, qc, qw, CASE WHEN qw IS NOT NULL THEN {quality.WORD_SHARE} * {distance('none', 'qw', nw)} END AS lw FROM l),
p AS (SELECT b.*, {share('cc', nc)} AS pc, {share('ww', nw)} AS pw FROM b),
far AS (SELECT p.doc_id, {distance('pc', 'qc', nc)} AS dc, CASE WHEN qw IS NOT NULL THEN {distance('pw', 'qw', nw)} END AS dw, lw
        FROM p JOIN lim ON lim.lang IS NOT DISTINCT FROM p.lang)
SELECT doc_id, n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (n_words >= 50 AND (coalesce(dc, 0) > 0.3 OR coalesce(dw > lw, false))) AS kept
FROM b LEFT JOIN far USING (doc_id)"""


#: The remainder modulo 4 of the crc32 of a decimal number, bit by bit.
_CRC4 = """(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
         lambda a, b: xor(a >> 8, list_reduce(list_prepend(xor(a & 255, b), range(8)),
                      lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)))) & 3"""

ORACLE_SQL = {
    "op11_conversation_trie": f"""
WITH t AS (SELECT conv_id AS c, md5(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS name,
                  len({_WORDS}) AS w, turn, coalesce(role, '') AS r FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, name, w, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, r, name) AS p FROM t),
own AS (SELECT c, 3 - ({_CRC4}) AS h, c - c % 20 AS base FROM (SELECT DISTINCT c FROM t) x),
rebuilt AS (SELECT own.c, 0 AS s, o.p, o.name, o.w FROM own JOIN o ON o.c = own.base WHERE o.p <= own.h
            UNION ALL SELECT own.c, 1, o.p, o.name, o.w FROM own JOIN o ON o.c = own.c WHERE o.p > own.h),
placed AS (SELECT c, name, w, row_number() OVER (PARTITION BY c ORDER BY s, p) AS depth FROM rebuilt),
lists AS (SELECT c, list(name ORDER BY depth) AS names, list(w ORDER BY depth) AS ws FROM placed GROUP BY c),
every AS (SELECT own.c, coalesce(names, []) AS names, coalesce(ws, []) AS ws FROM own LEFT JOIN lists USING (c)),
m AS (SELECT c, depth, array_to_string(names[1:depth], ' ') AS k, coalesce(ws[depth], 0) AS w, len(names) AS n
      FROM (SELECT *, unnest(range(0, len(names) + 1)) AS depth FROM every) x),
node AS (SELECT depth, k, min(c) AS conv_id, count(*) AS n_convs, any_value(w) AS w,
                sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE n = depth), '')) AS ends_sha256
         FROM m GROUP BY depth, k),
linked AS (SELECT node.*, up.k AS pk, pn.conv_id AS parent_conv_id FROM node
           LEFT JOIN m up ON up.c = node.conv_id AND up.depth = node.depth - 1
           LEFT JOIN node pn ON pn.depth = up.depth AND pn.k = up.k),
kids AS (SELECT depth - 1 AS depth, pk AS k, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY 1, 2),
counted AS (SELECT linked.*, coalesce(n_children, 0) AS n_children FROM linked LEFT JOIN kids USING (depth, k)),
below AS (SELECT m.depth, m.k, count(*) FILTER (WHERE counted.n_children = 0) AS n_leaves,
                 CAST(sum((counted.n_convs - 1) * counted.w) AS BIGINT) AS saved_tokens
          FROM counted JOIN m ON m.c = counted.conv_id AND m.depth <= counted.depth GROUP BY 1, 2)
SELECT conv_id, CAST(depth AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM counted JOIN below USING (depth, k)""",
    "op12_hard_negatives": """
WITH r AS (SELECT DISTINCT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS al, a.v AS av, c.vec_id AS id, c.label = a.label AS same,
             CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
      FROM r a JOIN r c ON a.vec_id % 50 = 0 AND c.vec_id <> a.vec_id),
p AS (SELECT anchor_id, al, av, id AS positive_id, score AS positive_score,
             row_number() OVER (PARTITION BY anchor_id, al, av ORDER BY score DESC, id) AS place
      FROM s WHERE same QUALIFY place <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, al, av, place ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id, al, av)
WHERE NOT same AND 100 * score BETWEEN 50 * positive_score AND 95 * positive_score
QUALIFY rank <= 3""",
    "op2_substring_dedup": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS k
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35) x),
hit AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p
        FROM (SELECT *, count(*) OVER (PARTITION BY k) AS c FROM win) y WHERE c > 1),
word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t
         FROM word ANTI JOIN hit USING (doc_id, p) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""",
    "op6_decontaminate": f"""
WITH it AS (SELECT item_id, {_NORMAL} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS k
       FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
             FROM it WHERE len(w) > 0) x),
d AS (SELECT doc_id, {_NORMAL} AS w FROM documents),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
             FROM d, (SELECT DISTINCT n FROM iw) z WHERE len(w) >= n) y),
m AS (SELECT doc_id, i, n, item_id FROM dw JOIN iw USING (n, k)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) x GROUP BY 1),
own AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) x GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN own USING (doc_id)""",
    "op8_quality_rules": _quality_sql(),
    "op4_url_filter": r"""
WITH parts AS (
  SELECT page_id, html,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), """ + _LOWER + r""") AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, html,
               CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
        FROM pages)),
named AS (
  SELECT page_id, html, host, path,
         CASE WHEN host <> '' THEN regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '(\.html|/)$', '') END AS canon,
         CASE WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
              WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
              WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
              WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
              WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM parts),
listed AS (
  SELECT DISTINCT canon FROM named
  WHERE canon IS NOT NULL AND regexp_matches(regexp_extract(html, '<title>([^<]*)', 1), '###|\*\*\*|%%%|\$\$\$'))
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
            WHEN rule IS NOT NULL OR canon IN (SELECT canon FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM named""",
    "op10_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, unnest(a) AS line, generate_subscripts(a, 1) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents)),
keyed AS (SELECT *, translate(trim(line, """ + _WS + r"""), """ + _LOWER + r""") AS key FROM lines),
shared AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE doc_id < last) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE last IS NULL OR doc_id >= last), '')) AS kept_sha256
FROM keyed LEFT JOIN shared USING (key) GROUP BY doc_id""",
}


def queries() -> dict:
    import corpus_pipeline
    return QUERIES | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict:
    return dict(ORACLE_SQL)
