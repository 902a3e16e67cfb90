"""The registered queries of the training-data operators, one per operator.

Each is a thin call of its operator on the whole table; ORACLE holds DuckDB SQL
where SQL can express the operator.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callcast.llm import chat, decontaminate, fingerprint, hard_negatives, jaccard_join, langid, licenses, mixing, suffix_dedup, toxicity, url_filter, warc, whitening
from callcast.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; learnt from four fifths of the labelled ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.identify(docs).select(
        "doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected"
    )


QUERIES["op7_language_id"] = op7_language_id


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every occurrence of a benchmark item in a document, with its edits."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.matches(docs, table(spark, sf_dir, "benchmark"))


QUERIES["op4_decontamination"] = op4_decontamination


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class and number of links of every document (five-word shingles, Jaccard 0.8)."""
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES["op9_jaccard_join"] = op9_jaccard_join


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that are left without the 400-byte strings that start twice or more.

    ``text`` is what is left, without characters of which only some bytes stay; ``without_passages``
    is the same for strings of PASSAGE_BYTES, which a passage of 51 words has.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = suffix_dedup.deduplicate(docs, as_text=True, passage=suffix_dedup.PASSAGE_BYTES)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.col("kept").alias("text"), "without_passages")


QUERIES["op8_suffix_dedup"] = op8_suffix_dedup


# The path rules (host, path, verdict), and terms of hosts whose pages are listed.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
LISTED_TERMS = ["pills", "casino", "bets", "spam", "adult", "ads-"]
# End of fixed values.


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict for every page URL; listed are the canonical URLs of all pages on hosts with a listed term."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.where(url_filter.host_of(F.col("url")).rlike("|".join(LISTED_TERMS))).select("url")
    return url_filter.judge(pages, "url", listed, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "listed")


QUERIES["op2_url_filter"] = op2_url_filter


def _url_sql() -> str:
    rules = " UNION ALL ".join(f"SELECT '{h}{p}' AS r, '{v}' AS v, '{h}' AS h, '{p}' AS p" for h, p, v in URL_RULES)
    return rf"""
WITH parts AS (
  SELECT page_id, url,
    translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
canon AS (
  SELECT *, CASE WHEN contains(url, '://') THEN regexp_replace(host, '^(www|m|blog)\.', '') || regexp_replace(path, '(/index)?(\.html?)?/*$', '') ELSE url END AS c
  FROM parts),
listed AS (SELECT DISTINCT c FROM canon WHERE regexp_matches(host, '{"|".join(LISTED_TERMS)}')),
rules AS ({rules}),
fit AS (
  SELECT page_id, arg_max(r, length(r)) AS rule, arg_max(v, length(r)) AS rule_verdict
  FROM parts, rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(rule_verdict, CASE WHEN l.c IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, l.c IS NOT NULL AS listed
FROM canon LEFT JOIN fit USING (page_id) LEFT JOIN listed l ON canon.c = l.c"""


ORACLE["op2_url_filter"] = _url_sql()

# Parameters of the mixture: tempering powers of the three margins.
MIX_POWERS = {"source": 0.7, "lang": 0.5, "topic": 0.8}
MIX_KEEP, MIX_ROUNDS, MIX_SEED, MIX_TOLERANCE = 0.5, 24, 11, 5e-4


def with_topic(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"topic": mixing.topic_of(F.coalesce("text", F.lit(""))), "tokens": mixing.token_count(F.col("text"))})


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chance and draw of every document, with token weights raked to source, language and topic shares."""
    docs = with_topic(table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")).select("doc_id", "source", "lang", "topic", "tokens")
    return mixing.sample(docs, list(MIX_POWERS), MIX_POWERS, keep_share=MIX_KEEP, rounds=MIX_ROUNDS, seed=MIX_SEED, tolerance=MIX_TOLERANCE)


QUERIES["op5_mixing"] = op5_mixing


def _fill_sql(name: str, source: str) -> tuple[list[str], str]:
    """Steps that find the factor of water-filling over a table (tokens, weight), and the name of the last one."""
    steps = [f"{name}0 AS MATERIALIZED (SELECT {MIX_KEEP} * SUM(tokens) / SUM(weight) AS f, {MIX_KEEP} * SUM(tokens) AS goal FROM {source})"]
    for i in range(1, 15):
        steps.append(
            f"{name}{i} AS MATERIALIZED (SELECT greatest(any_value(f), coalesce((any_value(goal) - coalesce(SUM(tokens) FILTER (weight / tokens * f >= 1), 0)) / SUM(weight) FILTER (weight / tokens * f < 1), any_value(f))) AS f, "
            f"any_value(goal) AS goal FROM {source}, {name}{i - 1})"
        )
    return steps, f"{name}14"


def _mix_sql() -> str:
    """The same raking, written out round by round over the cells; a block of rounds after the goals are met changes nothing."""
    margins, block = list(MIX_POWERS), mixing.CHECK_ROUNDS
    steps = []
    for m, power in MIX_POWERS.items():
        steps.append(
            f"share_{m} AS MATERIALIZED (SELECT {m}, tokens, t / SUM(t) OVER () * SUM(tokens) OVER () AS weight "
            f"FROM (SELECT {m}, SUM(tokens) AS tokens, pow(SUM(tokens), {power}) AS t FROM cells GROUP BY {m}))"
        )
        filled, factor = _fill_sql(f"w_{m}_", f"share_{m}")
        steps += filled
        steps.append(f"goal_{m} AS MATERIALIZED (SELECT {m}, round(least(1.0, weight / tokens * f), 9) * tokens AS goal FROM share_{m}, {factor})")
    goals = ", ".join(f"goal_{m}.goal AS g_{m}" for m in margins)
    joins = " ".join(f"JOIN goal_{m} ON cells.{m} IS NOT DISTINCT FROM goal_{m}.{m}" for m in margins)
    steps.append(f"start AS MATERIALIZED (SELECT cells.*, cells.tokens AS weight, {goals} FROM cells {joins})")
    last, open_ = "start", ""
    for r in range(MIX_ROUNDS):
        for m in margins:
            scaled = f"least(tokens, weight * g_{m} / SUM(weight) OVER (PARTITION BY {m}))"
            steps.append(f"r{r}_{m} AS MATERIALIZED (SELECT * REPLACE ({f'CASE WHEN {open_} THEN {scaled} ELSE weight END' if open_ else scaled} AS weight) FROM {last})")
            last = f"r{r}_{m}"
        if (r + 1) % block == 0 and r + 1 < MIX_ROUNDS:
            off = " UNION ALL ".join(f"SELECT max(abs(w - g)) / SUM(g) AS gap FROM (SELECT SUM(weight) AS w, any_value(g_{m}) AS g FROM {last} GROUP BY {m})" for m in margins)
            steps.append(f"gap{r} AS MATERIALIZED (SELECT max(gap) AS gap FROM ({off}))")
            open_ = f"(SELECT gap FROM gap{r}) > {MIX_TOLERANCE}"
    filled, factor = _fill_sql("f", last)
    steps += filled
    steps.append(f"chance AS (SELECT source, lang, topic, round(least(1.0, weight / tokens * f), 9) AS prob FROM {last}, {factor})")
    same = " AND ".join(f"d.{m} IS NOT DISTINCT FROM chance.{m}" for m in margins)
    return rf"""
WITH d AS (
  SELECT doc_id, source, lang,
    CASE WHEN contains(coalesce(text, ''), ' | ') THEN 'table' WHEN contains(coalesce(text, ''), '!!') THEN 'shout'
         WHEN contains(coalesce(text, ''), 'icense') THEN 'licensed' WHEN contains(coalesce(text, ''), '@') THEN 'contact' ELSE 'prose' END AS topic,
    greatest(len(regexp_extract_all(coalesce(text, ''), '\S+')), 1)::BIGINT AS tokens
  FROM documents),
cells AS MATERIALIZED (SELECT source, lang, topic, SUM(tokens)::DOUBLE AS tokens FROM d GROUP BY source, lang, topic),
{", ".join(steps)}
SELECT d.doc_id, d.source, d.lang, d.topic, d.tokens, prob,
  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':{MIX_SEED}'), 1, 13))::BIGINT / 4503599627370496.0 < prob AS kept
FROM d LEFT JOIN chance ON {same}"""


ORACLE["op5_mixing"] = _mix_sql()


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per page from the merged index of its archives; position is its place in the global order."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.archive_and_index(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "position")


QUERIES["op10_warc"] = op10_warc
ORACLE["op10_warc"] = rf"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, lower(coalesce(url, '')) AS u FROM pages),
k AS (
  SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS payload_digest,
    CASE WHEN contains(u, '://') THEN
      array_to_string(list_reverse(string_split(regexp_replace(regexp_extract(u, '^(?s:.*?)://([^/?#]*)', 1), '^www\.', ''), '.')), ',')
      || ')' || regexp_extract(u, '^(?s:.*?)://[^/?#]*([^#]*)', 1) ELSE u END AS url_key,
    strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(page_id % 31536000), '%Y%m%d%H%M%S') AS captured
  FROM p),
r AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS response FROM k)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {warc.REVISIT_BYTES} AND page_id <> response THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {warc.REVISIT_BYTES} AND page_id <> response THEN response END AS refers_to,
  url_key, captured, row_number() OVER (ORDER BY url_key, captured, page_id) AS position
FROM r"""


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and of its edited text, and how alike neighbours are."""
    return fingerprint.fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES["op3_fingerprints"] = op3_fingerprints


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every license notice found in a document."""
    return licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _license_sql() -> str:
    """The same windows with plain set containment, without sketches."""
    quoted = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in licenses.TEMPLATES)
    words = r"list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
    w = licenses.WIDTH

    def shingled(k: str, t: str) -> str:
        return (
            f"SELECT {k}, i - 1 AS pos, array_to_string(ws[i:i + {w - 1}], ' ') AS h FROM (SELECT {k}, ws, unnest(range(1, len(ws) - {w - 2})) AS i "
            f"FROM (SELECT {k}, {words} AS ws FROM {t}) q) r"
        )

    return f"""
WITH templates(license_id, text) AS (VALUES {quoted}),
ts AS (SELECT DISTINCT license_id, pos // {licenses.PIECE} AS piece, h FROM ({shingled("license_id", "templates")}) s),
known AS (SELECT license_id, piece, COUNT(*) AS m, pow(2, ceil(log2(COUNT(*))))::BIGINT AS class FROM ts GROUP BY 1, 2),
whole AS (SELECT license_id, SUM(m) AS n FROM known GROUP BY 1),
ds AS ({shingled("doc_id", "documents")}),
hit AS (SELECT DISTINCT doc_id, pos, ds.h, license_id, piece, class, m FROM ds JOIN ts USING (h) JOIN known USING (license_id, piece)),
held AS (
  SELECT doc_id, license_id, piece, m, pos // class - o AS win, COUNT(DISTINCT h) AS n, MIN(pos) AS first
  FROM hit, (SELECT unnest([0, 1, 2]) AS o) GROUP BY 1, 2, 3, 4, 5),
best AS (SELECT doc_id, license_id, piece, m, MAX(n / m) AS part, MIN(first) AS first FROM held GROUP BY 1, 2, 3, 4),
found AS (SELECT doc_id, license_id, round(SUM(part * m / whole.n), 6) AS containment, MIN(first)::BIGINT AS first_shingle FROM best JOIN whole USING (license_id) GROUP BY 1, 2)
SELECT * FROM found WHERE containment >= 0.8"""


QUERIES["op1_license_scan"] = op1_license_scan
ORACLE["op1_license_scan"] = _license_sql()


def op6_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dialogue from the perspective of each participant; the mask as start:end pairs."""
    shown = chat.perspectives(table(spark, sf_dir, "conversations"))
    pairs = F.transform("mask", lambda m: F.concat_ws(":", m["start"].cast("string"), m["end"].cast("string")))
    return shown.select("conv_id", "speaker", F.col("part")[0].alias("part"), "n_turns", "n_spoken", "text", F.array_join(pairs, ",").alias("mask"))


QUERIES["op6_chat_perspectives"] = op6_chat_perspectives
ORACLE["op6_chat_perspectives"] = f"""
WITH u AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
who AS (SELECT DISTINCT conv_id, role AS speaker FROM u WHERE role <> 'system'),
p AS (
  SELECT conv_id, speaker, turn // {chat.PART_TURNS} AS part, turn, role = speaker AS own,
    '{chat.START}' || CASE WHEN role = speaker THEN 'assistant' WHEN role = 'system' THEN role ELSE 'user name=' || role END || chr(10) AS head,
    replace(replace(text, '{chat.START}', '<|im_start |>'), '{chat.END}', '<|im_end |>') || '{chat.END}' || chr(10) AS body
  FROM u JOIN who USING (conv_id)),
o AS (
  SELECT *, SUM(length(head) + length(body)) OVER (PARTITION BY conv_id, speaker, part ORDER BY turn) AS stop FROM p)
SELECT conv_id, speaker, part, COUNT(*) AS n_turns, COUNT(*) FILTER (own) AS n_spoken, string_agg(head || body, '' ORDER BY turn) AS text,
  coalesce(string_agg((stop - length(body))::BIGINT || ':' || (stop - 1)::BIGINT, ',' ORDER BY turn) FILTER (own), '') AS mask
FROM o GROUP BY conv_id, speaker, part"""


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; learnt from the labels of four fifths of the labelled ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.judge(docs, table(spark, sf_dir, "labels")).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", F.size("matches").alias("n_matches")
    )


QUERIES["op11_toxicity"] = op11_toxicity


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First eight whitened components of every usable embedding."""
    return whitening.whitened_components(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), components=8)


QUERIES["op12_whitening"] = op12_whitening


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth embedding; where the id is divisible by 7 the label is first moved by one."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


QUERIES["op13_hard_negatives"] = op13_hard_negatives
ORACLE["op13_hard_negatives"] = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, list_inner_product(a.x, b.x)::BIGINT AS score
  FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank,
    s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score)
SELECT * FROM n WHERE rank <= 5"""
