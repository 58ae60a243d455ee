"""The registered queries of this subpackage and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subtide.llm.chat import format_conversations
from subtide.llm.decontamination import benchmark_matches
from subtide.llm.filter_audit import filter_audit
from subtide.llm.html_text import extract_main_text
from subtide.llm.jaccard_join import jaccard_components
from subtide.llm.licenses import license_scan
from subtide.llm.line_quality import quality_verdicts
from subtide.llm.packing import best_fit_packing
from subtide.llm.quality_ranking import quality_scores
from subtide.llm.repeats import repeated_spans
from subtide.llm.secrets import secret_scan
from subtide.llm.shared import table
from subtide.llm.spelling import spelling_variants
from subtide.llm.topk import top_k


def tokenizer_file() -> str:
    """The vocabulary that the packing query and the pipeline use; operators take any."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without strings of 400 bytes that also start elsewhere."""
    return repeated_spans(table(spark, sf_dir, "documents"), 400).drop("spans")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of all documents and what is left without lines that their host repeats."""
    return quality_verdicts(table(spark, sf_dir, "documents")).drop("host", "t1", "t2", "boilerplate")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose word trigrams overlap by nine tenths."""
    return jaccard_components(table(spark, sf_dir, "documents")).drop("text_hash")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learned from the labels outside the held-out fold."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts hold the template's own marks, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marks = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", marks), (-7, 1, "assistant", marks)], "conv_id long, turn long, role string, text string")
    done = format_conversations(rows.unionByName(own))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strings that may be secrets in all documents, and which of them are."""
    return secret_scan(table(spark, sf_dir, "documents"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract_main_text(table(spark, sf_dir, "pages"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where documents hold passages of the benchmark."""
    return benchmark_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and templates in all documents."""
    return license_scan(table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens."""
    return best_fit_packing(table(spark, sf_dir, "documents"), tokenizer_file())


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes at each step of all orders, per source."""
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, the frequent word one edit away and the root it leads to."""
    return spelling_variants(table(spark, sf_dir, "documents"))


def op13_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five vectors of largest integer inner product with each fiftieth vector."""
    return top_k(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_array_dedup": op1_suffix_array_dedup,
    "op2_quality_rules": op2_quality_rules,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_chat_formatting": op5_chat_formatting,
    "op6_secret_scan": op6_secret_scan,
    "op7_html_extraction": op7_html_extraction,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_license_scan": op9_license_scan,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_filter_audit": op11_filter_audit,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_exact_top_k": op13_exact_top_k,
}

# The formatted length follows from the grammar: marks of each role, and one guard per mark where the plain form would be misread.
_OP5_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), turns AS (
  SELECT *,
    CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 ELSE 14 + 2 * octet_length(encode(role)) END AS marks,
    len(regexp_extract_all(text, '[<\[]\\*(<SYS>>|</SYS>>|/?INST\]|/?s>|/?ROLE)')) AS guards,
    (regexp_matches(text, '[<\[]\\+(<SYS>>|</SYS>>|/?INST\]|/?s>|/?ROLE)')
      OR contains(text, CASE role WHEN 'system' THEN '<</SYS>>' WHEN 'user' THEN '[/INST]' WHEN 'assistant' THEN '</s>' ELSE '[/ROLE]' END)) AS misread
  FROM rows
), conversation AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
    sum(marks + length(text)) AS plain_chars, sum(guards) AS guards, bool_or(misread) AS misread
  FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  CAST(plain_chars + CASE WHEN misread THEN guards ELSE 0 END AS BIGINT) AS formatted_chars
FROM conversation
"""

_OP2_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, source AS host, coalesce(text, '') AS text FROM documents
), worded AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM docs
), lines AS (
  SELECT row, host, text, line, regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM (SELECT row, host, text, unnest(string_split(text, chr(10))) AS line FROM docs)
), worded_lines AS (
  SELECT row, host, text, line, len(words) AS n, array_to_string(words, ' ') AS plain FROM lines WHERE len(words) > 0
), dup_lines AS (
  SELECT row, count(*) - count(DISTINCT line) AS n_dup_lines FROM worded_lines GROUP BY row
), windows AS (
  SELECT row, unnest(generate_series(1, len(words) - 4)) AS place, words FROM worded WHERE len(words) >= 5
), keyed AS (
  SELECT row, place, array_to_string(words[place:place + 4], ' ') AS shingle FROM windows
), twice AS (
  SELECT row, place FROM (SELECT row, place, count(*) OVER (PARTITION BY row, shingle) AS n FROM keyed) WHERE n > 1
), repeat_words AS (
  SELECT row, count(DISTINCT place + k) AS n_repeat_words FROM twice, (SELECT unnest(generate_series(0, 4)) AS k) GROUP BY row
), hosts AS (
  SELECT host, count(DISTINCT text) AS documents FROM docs GROUP BY host
), frequent AS (
  SELECT host, plain FROM (SELECT host, plain, count(DISTINCT text) AS texts FROM worded_lines GROUP BY host, plain) AS f
  JOIN hosts USING (host) WHERE texts > 20 AND texts > 0.001 * documents
), gone AS (
  SELECT row, sum(n) AS n_boilerplate_words FROM worded_lines JOIN frequent USING (host, plain) GROUP BY row
), counted AS (
  SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, CAST(coalesce(n_boilerplate_words, 0) AS BIGINT) AS n_boilerplate_words
  FROM worded LEFT JOIN dup_lines USING (row) LEFT JOIN repeat_words USING (row) LEFT JOIN gone USING (row)
)
SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
  (NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND n_words - n_boilerplate_words >= 0.2 * n_words) AS kept
FROM counted
"""

# Bytes are pairs of hex digits. Every window of 400 bytes is counted by its MD5; windows that repeat form islands.
_OP1_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS digits FROM documents
), windows AS (
  SELECT row, start, md5_number(substring(digits, 2 * start + 1, 800)) AS piece
  FROM (SELECT row, digits, unnest(generate_series(0, len(digits) // 2 - 400)) AS start FROM docs WHERE len(digits) >= 800)
), repeated AS (
  SELECT row, start FROM windows SEMI JOIN (SELECT piece FROM windows GROUP BY piece HAVING count(*) > 1) AS again USING (piece)
), marked AS (
  SELECT row, start, sum(CASE WHEN start <= before + 400 THEN 0 ELSE 1 END) OVER (PARTITION BY row ORDER BY start) AS island
  FROM (SELECT row, start, lag(start) OVER (PARTITION BY row ORDER BY start) AS before FROM repeated)
), islands AS (
  SELECT row, min(start) AS first, max(start) + 400 AS past FROM marked GROUP BY row, island
), gaps AS (
  SELECT row, first, past, lag(past, 1, 0) OVER (PARTITION BY row ORDER BY first) AS gap FROM islands
), cut AS (
  SELECT row, CAST(sum(past - first) AS BIGINT) AS n_removed, count(*) AS n_spans, max(past) AS last_past,
    string_agg(substring(digits, 2 * gap + 1, 2 * (first - gap)), '' ORDER BY first) AS kept
  FROM gaps JOIN docs USING (row) GROUP BY row
)
SELECT doc_id, len(digits) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, '') || substring(digits, 2 * coalesce(last_past, 0) + 1))) AS kept_sha256
FROM docs LEFT JOIN cut USING (row)
"""

_OP3_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), shingles AS (
  SELECT DISTINCT row, shingle FROM (
    SELECT row, unnest(CASE WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
      ELSE list_transform(generate_series(1, len(words) - 2), lambda k: array_to_string(words[k:k + 2], ' ')) END) AS shingle
    FROM docs WHERE len(words) > 0)
), sizes AS (
  SELECT row, count(*) AS n FROM shingles GROUP BY row
), links AS (
  SELECT a.row AS one, b.row AS other FROM (
    SELECT a.row AS one, b.row AS other, count(*) AS shared FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.row < b.row GROUP BY a.row, b.row
  ) JOIN sizes a ON a.row = one JOIN sizes b ON b.row = other
  WHERE 100 * shared >= 90 * (a.n + b.n - shared)
), both_ways AS (
  SELECT one, other FROM links UNION ALL SELECT other, one FROM links
), reach(row, root) AS (
  SELECT row, row FROM docs
  UNION
  SELECT other, root FROM reach JOIN both_ways ON one = row
), smallest AS (
  SELECT reach.row, min(doc_id) AS component_id FROM reach JOIN docs ON docs.row = root GROUP BY reach.row
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM docs JOIN smallest USING (row) LEFT JOIN sizes USING (row)
"""

# Every order is run in full: the step at which a document goes is the first whose filter it fails.
_OP11_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
), worded AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first FROM docs
), failed AS (
  SELECT row, part,
    (CASE WHEN len(words) < 200 THEN 'A' ELSE '' END) || (CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END)
    || (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 'C' ELSE '' END)
    || (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END) || (CASE WHEN doc_id > first THEN 'E' ELSE '' END) AS fails,
    EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = worded.doc_id AND quality = 1) AS good,
    EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = worded.doc_id AND toxic = 1) AS toxic
  FROM worded
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f
), orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), steps AS (
  SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM orders
), lettered AS (
  SELECT filter_order, step, substring(filter_order, step, 1) AS f, substring(filter_order, 1, step - 1) AS earlier FROM steps
), kinds AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM failed GROUP BY part, fails
), ran AS (
  SELECT part, filter_order, step, f, fails, n, good, toxic, contains(fails, f) AS hit,
    earlier <> '' AND regexp_matches(fails, '[' || earlier || '-]') AS gone
  FROM kinds, lettered
), summed AS (
  SELECT part, filter_order, step, f,
    coalesce(sum(n) FILTER (NOT gone AND NOT hit), 0) AS kept, coalesce(sum(n) FILTER (NOT gone AND hit), 0) AS removed,
    coalesce(sum(n) FILTER (gone AND hit), 0) AS redundant, coalesce(sum(n) FILTER (fails = f), 0) AS unique_fails,
    coalesce(sum(good) FILTER (NOT gone AND hit), 0) AS good_lost, coalesce(sum(toxic) FILTER (NOT gone AND hit), 0) AS toxic_lost
  FROM ran GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM summed
"""

# CRC-32 a byte at a time with its table of 256 entries; words one edit apart share what is left of them without some letter.
_OP12_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
  FROM (SELECT unnest(generate_series(0::BIGINT, 255::BIGINT)) AS b)
), runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run
  FROM documents
), counted_runs AS (
  SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY id, run
), coded AS (
  SELECT *, hex(encode(id || ':' || run)) AS digits FROM counted_runs
), bytes AS (
  SELECT run, n, list_transform(generate_series(1, len(digits), 2),
    lambda k: CAST(16 * (instr('0123456789ABCDEF', digits[k]) - 1) + instr('0123456789ABCDEF', digits[k + 1]) - 1 AS BIGINT)) AS own FROM coded
), hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, own), lambda c, b: xor(c >> 8, t[CAST(xor(c & 255, b) AS INTEGER) + 1])), 4294967295) AS h FROM bytes, crc_table
), spelled AS (
  SELECT CASE WHEN h % 199 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelled WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), cut AS (
  SELECT word, n, place, substring(word, 1, place - 1) || substring(word, place + 1) AS rest
  FROM (SELECT word, n, unnest(generate_series(1, length(word))) AS place FROM words)
), near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.place = b.place AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, max(near_n) AS most FROM near GROUP BY word
), formed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.most >= 5 * w.n THEN b.most END AS form_n,
    CASE WHEN b.most >= 5 * w.n THEN (SELECT min(near) FROM near x WHERE x.word = w.word AND x.near_n = b.most) END AS form
  FROM words w LEFT JOIN best b USING (word)
), chain(word, root) AS (
  SELECT word, coalesce(form, word) FROM formed
  UNION
  SELECT c.word, f.form FROM chain c JOIN formed f ON c.root = f.word WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM formed f JOIN chain c USING (word) JOIN formed r ON r.word = c.root WHERE r.form IS NULL
"""

_OP13_SQL = r"""
WITH whole AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
  SELECT row, vec_id, unnest(v) AS x, unnest(generate_series(1, len(v))) AS dim FROM whole
), pairs AS (
  SELECT q.row AS asked, q.vec_id AS query_id, c.row, c.vec_id, sum(q.x * c.x) AS score
  FROM parts q JOIN parts c ON q.dim = c.dim AND q.row <> c.row WHERE q.vec_id % 50 = 0 GROUP BY q.row, q.vec_id, c.row, c.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY asked ORDER BY score DESC, vec_id) AS rank FROM pairs
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 5
"""

ORACLES: dict[str, str] = {
    "op1_suffix_array_dedup": _OP1_SQL,
    "op2_quality_rules": _OP2_SQL,
    "op3_jaccard_join": _OP3_SQL,
    "op5_chat_formatting": _OP5_SQL,
    "op11_filter_audit": _OP11_SQL,
    "op12_spelling_variants": _OP12_SQL,
    "op13_exact_top_k": _OP13_SQL,
}
