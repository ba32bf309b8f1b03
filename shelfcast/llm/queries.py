"""One named query per operator, on the whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.chat import chat_examples, read_turns, trained_text
from shelfcast.llm.collocations import mine_collocations
from shelfcast.llm.decontaminate import contaminated, find_contamination
from shelfcast.llm.language import identify_language
from shelfcast.llm.lines import keep_lines, line_bitmaps
from shelfcast.llm.packing import pack_documents
from shelfcast.llm.quality import score_quality
from shelfcast.llm.sampling import crc_of
from shelfcast.llm.secret_scan import BASE, scan_secrets, span_list
from shelfcast.llm.simhash import simhash_components
from shelfcast.llm.substrings import remove_repeats
from shelfcast.llm.topk import top_inner_products
from shelfcast.llm.toxicity import score_toxicity
from shelfcast.llm.whitening import whiten

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = simhash_components(table(spark, sf_dir, "documents"))
    return linked.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    left = keep_lines(docs, line_bitmaps(docs))
    return left.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


SQL["op2_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, i, l[i] AS line,
         translate(trim(l[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))
), often AS (
  SELECT key, max(doc_id) AS top FROM lines WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT doc_id, i, line, o.key IS NOT NULL AND doc_id < o.top AS lost FROM lines LEFT JOIN often o USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_of(F.col("doc_id")) % 4 == 2
    known = docs.where(~held_out).select(F.col("doc_id").alias("id"), F.col("lang").alias("label"))
    found = identify_language(docs, known)
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), F.coalesce("nearest", F.lit("und")).alias("lang_pred"), "score", "rejected")


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(table(spark, sf_dir, "documents"), tokenizer_file(), capacity=2048, end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), items, contaminated().alias("contaminated"))


SQL["op5_decontamination"] = r"""
WITH texts AS (
  SELECT doc_id AS id, 0 AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), items AS (
  SELECT item_id, words, least(13, len(words)) AS n
  FROM (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark)
  WHERE len(words) > 0
), wanted AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, n, array_to_string(words[s:s + n - 1], ' ') AS w
  FROM (SELECT item_id, words, n, unnest(range(1, len(words) - n + 2)) AS s FROM items)
), sizes AS (
  SELECT DISTINCT n FROM items
), seen AS (
  SELECT id, n, s, array_to_string(words[s:s + n - 1], ' ') AS w
  FROM (SELECT id, words, n, unnest(range(1, len(words) - n + 2)) AS s FROM texts, sizes WHERE len(words) >= n)
), hits AS (
  SELECT id, n, s, item_id FROM seen JOIN wanted USING (n, w)
), covered AS (
  SELECT id, count(DISTINCT i) AS n_hit FROM (SELECT id, unnest(range(s, s + n)) AS i FROM hits) GROUP BY id
), named AS (
  SELECT id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT id, item_id FROM hits) GROUP BY id
)
SELECT id AS doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM texts LEFT JOIN covered USING (id) LEFT JOIN named USING (id)
"""


@query
def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    fixed = spark.range(2).select(F.lit(-7).cast("long"), F.col("id"), F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(said))
    examples = chat_examples(turns.unionAll(fixed))
    back = read_turns(F.col("formatted"))
    digest = F.sha2(F.array_join(F.transform(back, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256)
    trained = trained_text(F.col("formatted"), F.col("loss_start"), F.col("loss_end"))
    read = examples.select(
        "conv_id",
        "example",
        trained.alias("trained"),
        F.length("formatted").cast("long").alias("chars"),
        F.when(F.col("whole"), F.size(back)).cast("long").alias("n_turns"),
        F.when(F.col("whole"), digest).alias("turns_sha256"),
    )
    loss = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "trained"))), lambda x: x["trained"]), "")
    grouped = read.groupBy("conv_id").agg(F.max("n_turns").alias("n_turns"), F.max("turns_sha256").alias("turns_sha256"), loss.alias("loss"), F.sum("chars").alias("formatted_chars"))
    return grouped.select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


SQL["op6_chat_format"] = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, row_number() OVER o AS i, count(*) OVER (PARTITION BY conv_id) AS n,
    sum(14 + length(replace(replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '[', '&lb;'), ']', '&rb;'))
           + length(replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '[', '&lb;'), ']', '&rb;'))) OVER o AS upto
  FROM said WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(CASE WHEN role = 'assistant' THEN 7 + upto WHEN i = n THEN 3 + upto ELSE 0 END)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    return score_quality(table(spark, sf_dir, "documents"), labels)


def toxic_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels that may be learnt from."""
    labels = table(spark, sf_dir, "labels").where(crc_of(F.col("doc_id")) % 5 != 0)
    return labels.select(F.col("doc_id").alias("id"), F.col("toxic").alias("label"))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), toxic_labels(spark, sf_dir))
    held_out = F.coalesce(crc_of(F.col("doc_id")) % 5 == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


@query
def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    of = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[of(r.kind).alias(f"n_{r.kind}") for r in BASE],
        F.sha2(span_list(F.col("secrets"), [r.kind for r in BASE]), 256).alias("base_sha256"),
        span_list(F.col("secrets")).alias("spans"),
    )


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = remove_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL["op10_substring_dedup"] = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, s, array_to_string(words[s:s + 19], ' ') AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS s FROM texts WHERE len(words) >= 20)
), later AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY w ORDER BY doc_id, s) AS k FROM windows) WHERE k > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM later
), places AS (
  SELECT doc_id, words[i] AS word, i FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM texts)
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n FROM places ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT t.doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts t LEFT JOIN kept USING (doc_id)
"""


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_collocations(table(spark, sf_dir, "documents"), least=100, longest=5, top=2000)


SQL["op11_collocations"] = r"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang
), often AS (
  SELECT lang, m, phrase, count(*) AS f
  FROM (SELECT lang, m, array_to_string(w[s:s + m - 1], ' ') AS phrase
        FROM (SELECT lang, m, w, unnest(range(1, len(w) - m + 2)) AS s FROM pieces, range(1, 6) lengths(m) WHERE len(w) >= m))
  GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
  SELECT lang, m, phrase, f, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:m], ' ') AS tail
  FROM (SELECT lang, m, phrase, f, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k FROM often WHERE m >= 2)
), scored AS (
  SELECT lang, phrase, c.f AS a, k, h.f AS l, t.f AS r, n, CAST((1000::HUGEINT * c.f * n) // (h.f::HUGEINT * t.f) AS BIGINT) AS score
  FROM cuts c JOIN (SELECT lang, phrase AS head, f FROM often) h USING (lang, head) JOIN (SELECT lang, phrase AS tail, f FROM often) t USING (lang, tail) JOIN totals USING (lang)
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ends AS (
  SELECT lang, f AS a, array_to_string(string_split(phrase, ' ')[1:m - 1], ' ') AS phrase FROM often WHERE m >= 3
  UNION SELECT lang, f, array_to_string(string_split(phrase, ' ')[2:m], ' ') FROM often WHERE m >= 3
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM scored ANTI JOIN ends USING (lang, phrase, a) QUALIFY rank <= 2000
"""


@query
def op12_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_inner_products(vectors.where(F.col("vec_id") % 100 == 0), vectors, k=10, scale=1024)


SQL["op12_topk_search"] = r"""
WITH entries AS (
  SELECT vec_id, unnest(embedding)::DOUBLE AS c, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
), x AS (
  SELECT vec_id, i, CAST(floor(1024 * c) AS BIGINT) AS x FROM entries
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM x q JOIN x c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0 GROUP BY ALL
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 10
"""


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whiten(table(spark, sf_dir, "embeddings"), scale=256, components=4)
    return white.withColumn("deviation", F.col("deviation").try_cast("long"))
