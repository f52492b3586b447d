"""Contract queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .alignment import align_report
from .bpe import encode_digest
from .chat import dialogues
from .collocations import collocations
from .common import table
from .exact_dedup import exact_dedup
from .jaccard_join import jaccard_components
from .line_dedup import LONG_WORDS, line_report
from .mixing import mix_report
from .packing import WORD_VOCABULARY, byte_ids, word_ids, write_packed
from .quality_model import classify
from .quality_rules import judge
from .simhash_dedup import simhash_report
from .substring_dedup import substring_report

QUERIES, ORACLE_SQL = {}, {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weak label, score and verdict of every document."""
    return classify(table(spark, sf_dir, "documents"))


@query
def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation rendered from each participant's point of view, cut by position."""
    return dialogues(table(spark, sf_dir, "conversations"))


@query
def op2_chat_format_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name that op2_chat_format's cut by position had before it took that over."""
    return dialogues(table(spark, sf_dir, "conversations"))


ORACLE_SQL["op2_chat_format_by_position"] = """
WITH numbered AS (
  SELECT conv_id, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS n
  FROM (SELECT conv_id, coalesce(turn, 9223372036854775807) AS turn,
               replace(coalesce(role, 'unknown'), '|', '\\|') AS role,
               regexp_replace(coalesce(text, ''), '<(\\\\*)[|]', '<\\1\\\\|', 'g') AS text
        FROM conversations)),
shown AS (
  SELECT *, n // 256 AS segment, false AS framed FROM numbered
  UNION ALL
  SELECT f.*, s.segment, true FROM numbered f
  JOIN (SELECT DISTINCT conv_id, n // 256 AS segment FROM numbered WHERE n >= 256) s
    ON f.conv_id IS NOT DISTINCT FROM s.conv_id
  WHERE f.n < 256 AND f.role = 'system'),
view AS (
  SELECT s.*, p.role AS perspective, s.role = p.role AS own,
         CASE WHEN s.role = p.role THEN '<|assistant|>' WHEN s.role = 'system' THEN '<|system|>'
              ELSE '<|user:' || s.role || '|>' END || chr(10) AS head
  FROM shown s JOIN (SELECT DISTINCT conv_id, role FROM numbered WHERE role <> 'system') p
    ON s.conv_id IS NOT DISTINCT FROM p.conv_id),
placed AS (
  SELECT *, length(head) + length(text) + 8 AS chars,
         CAST(sum(length(head) + length(text) + 8) OVER (
           PARTITION BY conv_id, segment, perspective ORDER BY n) AS BIGINT) AS upto FROM view),
piece AS (
  SELECT conv_id, segment, perspective, min(n) FILTER (NOT framed) AS first_turn,
         CAST(sum(chars) FILTER (NOT framed) AS BIGINT) AS size,
         CAST(coalesce(sum(chars) FILTER (framed), 0) AS BIGINT) AS frame_chars,
         string_agg(head || text || '<|end|>' || chr(10), '' ORDER BY n) AS rendered,
         coalesce(string_agg((upto - length(text) - 8) || '-' || upto, ',' ORDER BY n)
                  FILTER (own), '') AS mask,
         count(*) FILTER (NOT framed) AS n_turns, count(*) FILTER (own) AS n_own
  FROM placed GROUP BY conv_id, segment, perspective)
SELECT conv_id, segment, perspective, first_turn,
       CAST(sum(size) OVER (PARTITION BY conv_id, perspective ORDER BY segment) AS BIGINT) - size
         AS "offset", frame_chars, rendered, mask, n_turns, n_own
FROM piece
"""
ORACLE_SQL["op2_chat_format"] = ORACLE_SQL["op2_chat_format_by_position"]


@query
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact dedup of all documents by a tree merge of digest runs."""
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLE_SQL["op3_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                               'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
WINDOW same AS (PARTITION BY norm)
"""


@query
def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes left of every document without 50-byte strings of earlier documents."""
    return substring_report(table(spark, sf_dir, "documents"))


@query
def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-copy component of every document."""
    return simhash_report(table(spark, sf_dir, "documents"))


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines left of every document after its later repeated runs are deleted."""
    return line_report(table(spark, sf_dir, "documents"))


ORACLE_SQL["op6_line_dedup"] = """
WITH line AS (
  SELECT doc_id, i, string_split(coalesce(text, ''), chr(10))[i] AS line
  FROM (SELECT doc_id, text,
               unnest(range(1, 1 + len(string_split(coalesce(text, ''), chr(10))))) AS i
        FROM documents)),
worded AS (
  SELECT doc_id, i, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t,
         row_number() OVER (PARTITION BY doc_id ORDER BY i) AS pos
  FROM line WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
pair AS (
  SELECT doc_id, i, pos, t, lead(t) OVER (PARTITION BY doc_id ORDER BY i) AS t2 FROM worded),
marked AS (
  SELECT doc_id, i, pos, t2 IS NOT NULL AND row_number() OVER (
    PARTITION BY t, t2 ORDER BY doc_id, pos) > 1 AS again FROM pair),
gone AS (
  SELECT doc_id, i, pos,
         again OR coalesce(lag(again) OVER (PARTITION BY doc_id ORDER BY pos), false) AS gone
  FROM marked),
runs AS (
  SELECT doc_id, i, gone, gone AND NOT coalesce(
    lag(gone) OVER (PARTITION BY doc_id ORDER BY pos), false) AS starts FROM gone)
SELECT l.doc_id, count(r.i) AS n_lines, count(*) FILTER (r.gone) AS n_removed,
       count(*) FILTER (r.starts) AS n_runs,
       sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.i)
                       FILTER (NOT coalesce(r.gone, false)), '')) AS kept_sha256
FROM line l LEFT JOIN runs r ON l.doc_id = r.doc_id AND l.i = r.i
GROUP BY l.doc_id
"""


@query
def op6_line_dedup_long_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6_line_dedup where every long line is a run of its own as well."""
    return line_report(table(spark, sf_dir, "documents"), long_words=LONG_WORDS)


ORACLE_SQL["op6_line_dedup_long_lines"] = """
WITH line AS (
  SELECT doc_id, i, string_split(coalesce(text, ''), chr(10))[i] AS line
  FROM (SELECT doc_id, text,
               unnest(range(1, 1 + len(string_split(coalesce(text, ''), chr(10))))) AS i
        FROM documents)),
worded AS (
  SELECT doc_id, i, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t,
         row_number() OVER (PARTITION BY doc_id ORDER BY i) AS pos
  FROM line WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
pair AS (
  SELECT doc_id, i, pos, t, lead(t) OVER (PARTITION BY doc_id ORDER BY i) AS t2 FROM worded),
marked AS (
  SELECT doc_id, i, pos, t2 IS NOT NULL AND row_number() OVER (
    PARTITION BY t, t2 ORDER BY doc_id, pos) > 1 AS again,
    len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')) >= 50 AND row_number() OVER (
    PARTITION BY t ORDER BY doc_id, pos) > 1 AS alone FROM pair),
gone AS (
  SELECT doc_id, i, pos, alone
         OR again OR coalesce(lag(again) OVER (PARTITION BY doc_id ORDER BY pos), false) AS gone
  FROM marked),
runs AS (
  SELECT doc_id, i, gone, gone AND NOT coalesce(
    lag(gone) OVER (PARTITION BY doc_id ORDER BY pos), false) AS starts FROM gone)
SELECT l.doc_id, count(r.i) AS n_lines, count(*) FILTER (r.gone) AS n_removed,
       count(*) FILTER (r.starts) AS n_runs,
       sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.i)
                       FILTER (NOT coalesce(r.gone, false)), '')) AS kept_sha256
FROM line l LEFT JOIN runs r ON l.doc_id = r.doc_id AND l.i = r.i
GROUP BY l.doc_id
"""


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mix_report(table(spark, sf_dir, "documents"))


ORACLE_SQL["op7_mixing"] = """
WITH RECURSIVE sized AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':7') AS place
  FROM documents),
part AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [3, 1, 2][1 + CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT)] AS w
  FROM sized GROUP BY source),
filled AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
             - coalesce(sum(2 * source_size) OVER before, 0))
            / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level
  FROM part
  WINDOW before AS (ORDER BY source_size / w::DOUBLE, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
target AS (
  SELECT source, source_size,
         least(2.0::DOUBLE * source_size, w * max(level) OVER ()) AS target FROM filled),
goal AS (
  SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS words FROM target),
laid AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, g.words,
         CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.place, s.doc_id) AS BIGINT)
           - s.size AS start
  FROM sized s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       CASE WHEN size = 0 THEN 0 ELSE words // source_size * size
         + greatest(0, least(size, words % source_size - start)) END AS taken
FROM laid
"""


@query
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BPE ids and decoded text of all documents, as digests."""
    return encode_digest(table(spark, sf_dir, "documents"))


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality cascade's counts and verdict for every document."""
    return judge(table(spark, sf_dir, "documents"))


@query
def op10_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed rows of all documents' token ids, written and read again, with a digest of the ids."""
    return digests(write_packed(table(spark, sf_dir, "documents"), scratch_path(spark, "packed")))


@query
def op10_token_packing_word_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name that op10_token_packing over token ids had before it took that over."""
    return digests(write_packed(table(spark, sf_dir, "documents"),
                                scratch_path(spark, "packed-words"),
                                encoder=word_ids, vocabulary=WORD_VOCABULARY))


@query
def op10_token_packing_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10_token_packing over the texts' bytes as ids."""
    return digests(write_packed(table(spark, sf_dir, "documents"),
                                scratch_path(spark, "packed-bytes"),
                                encoder=byte_ids, vocabulary=256))


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of two and three words of every language."""
    return collocations(table(spark, sf_dir, "documents"))


ORACLE_SQL["op11_collocations"] = """
WITH said AS (
  SELECT coalesce(lang, 'und') AS lang, translate(
    coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
piece AS (
  SELECT lang, regexp_extract_all(unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')),
                                  '[^\\x20\\x09]+') AS w FROM said),
place AS (SELECT lang, w, unnest(range(1, 1 + len(w))) AS i FROM piece WHERE len(w) > 0),
gram AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, CAST(count(*) AS HUGEINT) AS f
  FROM place CROSS JOIN (VALUES (1), (2), (3)) s(k) WHERE i + k - 1 <= len(w)
  GROUP BY ALL),
size AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM gram WHERE k = 1 GROUP BY lang),
often AS (SELECT *, string_split(phrase, ' ') AS w FROM gram WHERE f >= 10),
cut AS (
  SELECT c.lang, c.k, c.phrase, c.w, c.f, h.k AS split, h.f AS l, t.f AS r,
         1000000 * c.f * c.f // (h.f * t.f) AS score
  FROM often c JOIN often h ON h.lang = c.lang AND h.k < c.k
                           AND h.phrase = array_to_string(c.w[1:h.k], ' ')
  JOIN often t ON t.lang = c.lang AND t.k = c.k - h.k
              AND t.phrase = array_to_string(c.w[h.k + 1:], ' ')),
weakest AS (
  SELECT * FROM cut QUALIFY row_number() OVER (
    PARTITION BY lang, phrase ORDER BY score, split) = 1),
kept AS (
  SELECT * FROM weakest a WHERE NOT EXISTS (
    SELECT 1 FROM often b WHERE a.k = 2 AND b.k = 3 AND b.lang = a.lang
    AND 100 * b.f >= 50 * a.f
    AND a.phrase IN (array_to_string(b.w[1:2], ' '), array_to_string(b.w[2:3], ' ')))),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY lang ORDER BY score DESC, f DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank, phrase, CAST(f AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       n, CAST(score AS BIGINT) AS score
FROM ranked JOIN size USING (lang) WHERE rank <= 2000
"""


@query
def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document, linked at a Jaccard similarity of 0.9."""
    return jaccard_components(table(spark, sf_dir, "documents"))


@query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of two public vocabularies, by document."""
    return align_report(table(spark, sf_dir, "documents"))


def digests(packed: DataFrame) -> DataFrame:
    return packed.select("row_id", F.sha2("ids", 256).alias("ids_sha256"), "n_tokens",
                         "cu_seqlens", "position_resets", "doc_ids", "pieces")
