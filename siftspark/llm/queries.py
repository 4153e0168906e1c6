"""One query per operator: whole tables, production parameters, and SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from siftspark.catalog.base import table
from siftspark.llm.base import ORACLE, QUERIES, query
from siftspark.llm.chat import digests, events_of_rows, fold_events, render
from siftspark.llm.collocations import collocations
from siftspark.llm.common import held_out, staged
from siftspark.llm.decontaminate import find_passages
from siftspark.llm.jaccard import similarity_components
from siftspark.llm.mixture import mixture
from siftspark.llm.quality_model import learn as learn_quality
from siftspark.llm.quality_model import score_quality
from siftspark.llm.quality_rules import judge_quality
from siftspark.llm.repair import repair_conversations
from siftspark.llm.secrets import BASE_KINDS, scan_secrets, span_list
from siftspark.llm.suffix_dedup import remove_repeats
from siftspark.llm.toxicity import learn as learn_toxicity
from siftspark.llm.toxicity import score_toxicity
from siftspark.llm.warc import archive
from siftspark.llm.wavelet import read_shards, with_starts, write_shards
from siftspark.session import work_path

__all__ = ["ORACLE", "QUERIES"]


@query("""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
                  sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p GROUP BY ALL)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
FROM p JOIN f USING (payload_digest)
""")
def op3_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record in a ZIP package, read back by range."""
    records = archive(table(spark, sf_dir, "pages"), payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query(r"""
WITH sized AS (
  SELECT doc_id, source, ('0x' || substr(md5('20:' || doc_id), 1, 10))::BIGINT AS k,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
totals AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w
  FROM sized GROUP BY source),
steps AS (
  SELECT *, sum(source_size) OVER () AS words,
         coalesce(sum(source_size * 3) OVER before, 0) AS capped,
         sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS rest,
         row_number() OVER (ORDER BY source_size / w, source NULLS LAST) AS step
  FROM totals
  WINDOW before AS (ORDER BY source_size / w, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT coalesce(arg_min((words - capped)::DOUBLE / rest::DOUBLE, step)
                  FILTER (source_size * 3 >= w * (words - capped)::DOUBLE / rest::DOUBLE), 0) AS level
  FROM steps),
targets AS (SELECT source, source_size, least(w * level, (source_size * 3)::DOUBLE) AS target FROM totals, level),
placed AS (
  SELECT doc_id, size, source_size, target, round(target)::BIGINT AS budget,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY k, doc_id
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (budget // greatest(source_size, 1) * size
        + least(greatest(budget % greatest(source_size, 1) - before, 0), size))::BIGINT AS taken
FROM placed
""")
def op5_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words each document gives to a mix with weights 5, 2, 1 and at most three epochs."""
    docs = table(spark, sf_dir, "documents")
    return mixture(docs).select("doc_id", "size", "source_size", "target", "taken")


@query(r"""
WITH rows AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
marks AS (
  SELECT *, text LIKE '%\\%' OR regexp_matches(text, '</?s>|\[/?INST\]|<</?(SYS|ROLE)>>') AS special,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n
  FROM rows),
sized AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '\\|</?s>|\[/?INST\]|<</?(SYS|ROLE)>>'))
            + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 6 ELSE 15 END
            + CASE WHEN n = 1 THEN 3 ELSE 0 END AS chars
  FROM marks)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
""")
def op9_chat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that quotes the template, folded, rendered and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    quote = "</s>[INST] ok [/INST]"
    quoting = spark.createDataFrame(
        [(-7, 0, "user", quote), (-7, 1, "assistant", quote)], rows.schema
    )
    return digests(render(fold_events(events_of_rows(rows.unionByName(quoting)))))


@query()
def op6_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document, look-alikes only where few owners hold the value."""
    scanned = scan_secrets(table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return scanned.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(span_list(base).cast("binary"), 256).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
    )


@query()
def op8_pattern_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability of being toxic for every document, from its matched clauses."""
    docs = table(spark, sf_dir, "documents")
    model = learn_toxicity(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model, ["doc_id"]).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query()
def op2_ftrl_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability of good quality for every document."""
    docs = table(spark, sf_dir, "documents")
    weights = learn_quality(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, weights, ["doc_id"]).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query()
def op7_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and the verdict by divergence from the language, for every document."""
    return judge_quality(table(spark, sf_dir, "documents"))


@query(r"""
WITH plain AS (
  SELECT doc_id, string_split_regex(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}\x20\x09-\x0d]+', '', 'g'),
                                    '[\x20\x09-\x0d]+') AS words FROM documents),
d AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i
      FROM (SELECT doc_id, list_filter(words, lambda x: x <> '') AS w FROM plain)),
items AS (
  SELECT item_id, list_filter(string_split_regex(
           regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}\x20\x09-\x0d]+', '', 'g'),
           '[\x20\x09-\x0d]+'), lambda x: x <> '') AS w FROM benchmark),
b AS (SELECT item_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM items),
m AS (SELECT doc_id, item_id, n, i - j AS shift, j FROM d JOIN b USING (word)),
dense AS (SELECT * FROM m QUALIFY count(*) OVER (PARTITION BY doc_id, item_id, shift) >= 5),
w AS (SELECT doc_id, item_id, n, count(*) OVER (PARTITION BY doc_id, item_id, shift ORDER BY j
             RANGE BETWEEN CURRENT ROW AND 11 FOLLOWING) AS c FROM dense)
SELECT doc_id, item_id, max(c)::INT AS best_window FROM w
WHERE c * 12 >= least(n, 12) * 10 GROUP BY doc_id, item_id
""")
def op1_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item, with the words in place in the best window."""
    found = find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "best_window")


@query(r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0d]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k
      FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM c WHERE 100 * k >= 80 * (na + nb - k)),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION
                SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.b) AS component_id
FROM s JOIN reach r ON r.a = s.doc_id GROUP BY ALL
""")
def op10_jaccard_metric_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact near-duplicate components of all documents at Jaccard similarity 0.8."""
    found = similarity_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


@query()
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes each document loses to strings of 50 bytes in documents with smaller ids."""
    kept = remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query(r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0a-\x0d]')) AS piece
  FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
grams AS (
  SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
  FROM w, range(1, 6) AS lengths(m)),
f AS (SELECT lang, m, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
cuts AS (SELECT *, unnest(range(1, m)) AS k FROM c),
scored AS (
  SELECT cuts.lang, cuts.phrase, cuts.a, k, h.a AS l, t.a AS r, n,
         ((1000::HUGEINT * cuts.a * n) // (h.a::HUGEINT * t.a))::BIGINT AS score
  FROM cuts JOIN totals USING (lang)
  JOIN f h ON h.lang = cuts.lang AND h.phrase = array_to_string(w[1:k], ' ')
  JOIN f t ON t.lang = cuts.lang AND t.phrase = array_to_string(w[k + 1:], ' ')),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT c.lang, array_to_string(w[i:j], ' ') AS phrase, max(a) AS a
  FROM c, range(1, 6) AS starts(i), range(1, 6) AS ends(j)
  WHERE j <= m AND j > i AND j - i + 1 < m GROUP BY ALL),
alone AS (SELECT weakest.* FROM weakest ANTI JOIN inside
          ON inside.lang = weakest.lang AND inside.phrase = weakest.phrase AND 100 * inside.a >= 100 * weakest.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM alone QUALIFY rank <= 2000
""")
def op11_toivonen_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 strongest collocations of each language, from exact counts of all documents."""
    return collocations(table(spark, sf_dir, "documents"))


@query()
def op12_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token ids in wavelet matrices, read back from the files."""
    folder = work_path(spark, "wavelet-shards")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    written = write_shards(table(spark, sf_dir, "documents"), folder, tokenizer)
    return read_shards(with_starts(staged(written, "shards")))


@query()
def op13_cyk_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations with their faults, cheapest edits and repaired digest."""
    found = repair_conversations(table(spark, sf_dir, "conversations"))
    return found.select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )


@query(corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents through the stages of the corpus pipeline."""
    return corpus_pipeline.run(spark, sf_dir)
