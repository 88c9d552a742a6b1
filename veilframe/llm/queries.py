"""One query per operator, over whole tables, with SQL where SQL can express it.

``QUERIES[name](spark, folder)`` runs on ``<folder>/<table>.parquet``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.llm.arrays import small_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query()
def op2_bpe_word_table(spark: SparkSession, folder: str) -> DataFrame:
    from veilframe.llm.bpe import encode_decode

    found = encode_decode(table(spark, folder, "documents"), tokenizer_file())
    return found.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


# Windows of items are joined with windows of documents, both as texts of words.
@query(
    r"""
    WITH doc AS (
      SELECT row_number() OVER () AS r, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM documents),
    item AS (
      SELECT CAST(item_id AS VARCHAR) AS item_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM benchmark),
    item_window AS (
      SELECT DISTINCT item_id, least(len(w), 13) AS n,
             array_to_string(w[i : i + 12], ' ') AS g
      FROM item, LATERAL unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS t(i) WHERE len(w) > 0),
    sizes AS (SELECT DISTINCT n FROM item_window),
    doc_window AS (
      SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS g
      FROM doc, sizes, LATERAL unnest(range(1, len(w) - n + 2)) AS t(i) WHERE len(w) >= n),
    hit AS (SELECT r, i, d.n, item_id FROM doc_window d JOIN item_window USING (n, g)),
    place AS (SELECT DISTINCT r, unnest(range(i, i + n)) AS p FROM hit),
    words AS (SELECT r, count(*) AS n_hit FROM place GROUP BY r),
    items AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
              FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM doc LEFT JOIN words USING (r) LEFT JOIN items USING (r)
    """
)
def op3_decontaminate_index(spark: SparkSession, folder: str) -> DataFrame:
    from veilframe.llm.decontaminate import find_phrases

    found = find_phrases(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


@query()
def op4_pii_anchors(spark: SparkSession, folder: str) -> DataFrame:
    from veilframe.llm.pii import find_pii

    found = find_pii(table(spark, folder, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["kind"].isin("email", "ip", "card", "phone"))
    count = lambda kind: F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in ("email", "ip", "card", "phone")],
        F.sha2(joined_spans(base), 256).alias("base_sha256"),
        joined_spans(F.col("pii")).alias("spans"),
    )


def joined_spans(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined in the order they have."""
    texts = F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(texts, ",")


@query()
def op7_language_viterbi(spark: SparkSession, folder: str) -> DataFrame:
    from veilframe.llm.language import held_out, identify, train

    docs = table(spark, folder, "documents")
    found = identify(docs.select("doc_id", "text"), train(docs))
    return found.select(
        "doc_id", held_out("doc_id").alias("held_out"), "lang_pred", F.col("lang_score").alias("score")
    )


@query()
def op9_cross_polytope(spark: SparkSession, folder: str) -> DataFrame:
    from veilframe.llm.neighbours import nearest

    found = nearest(table(spark, folder, "embeddings"))
    return found.select(F.col("query").alias("query_id"), "rank", "vec_id", "score")


@query()
def op10_toxicity_trees(spark: SparkSession, folder: str) -> DataFrame:
    from veilframe.llm.language import held_out
    from veilframe.llm.toxicity import score_texts, train

    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = score_texts(docs, train(docs, table(spark, folder, "labels")))
    return scored.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query()
def op5_dart_minhash(spark: SparkSession, folder: str) -> DataFrame:
    from veilframe.llm.near_copies import near_copies

    return near_copies(table(spark, folder, "documents"))


# Strings are hexadecimal text, two digits a byte, and compared by their MD5;
# texts are first cut into overlapping pieces, in which finding a place is cheap.
@query(
    """
    WITH doc AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    piece AS (SELECT r, doc_id, c, substr(h, 2000 * c + 1, 2098) AS p
              FROM doc, LATERAL unnest(range(0, length(h) // 2000 + 1)) AS t(c)),
    win AS (SELECT r, doc_id, 1000 * c + j AS i, md5_number(substr(p, 2 * j - 1, 100)) AS s
            FROM piece, LATERAL unnest(range(1, least(1000, length(p) // 2 - 49) + 1)) AS t(j)
            WHERE length(p) >= 100),
    low AS (SELECT s, min(doc_id) AS first FROM win GROUP BY s HAVING min(doc_id) < max(doc_id)),
    gone AS (SELECT r, i FROM win JOIN low USING (s) WHERE doc_id > first),
    mark AS (SELECT r, i, max(i) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
             FROM gone),
    run AS (SELECT r, i, sum(CASE WHEN prev IS NULL OR i > prev + 50 THEN 1 ELSE 0 END)
                         OVER (PARTITION BY r ORDER BY i) AS g FROM mark),
    span AS (SELECT r, g, min(i) AS a, max(i) + 50 AS b FROM run GROUP BY r, g),
    gap AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 1) AS from_,
                   lead(a) OVER (PARTITION BY r ORDER BY a) AS next_ FROM span),
    kept AS (SELECT r, string_agg(substr(h, 2 * from_ - 1, 2 * (a - from_))
                                  || CASE WHEN next_ IS NULL THEN substr(h, 2 * b - 1) ELSE '' END, '' ORDER BY a) AS k,
                    sum(b - a) AS n_removed, count(*) AS n_spans
             FROM gap JOIN doc USING (r) GROUP BY r)
    SELECT doc_id, CAST(length(h) / 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
           coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
    FROM doc LEFT JOIN kept USING (r)
    """
)
def op8_repeats_cover(spark: SparkSession, folder: str) -> DataFrame:
    from veilframe.llm.repeats import remove_repeats

    found = remove_repeats(table(spark, folder, "documents"))
    total = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        total.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query()
def op6_secret_tests(spark: SparkSession, folder: str) -> DataFrame:
    from veilframe.llm.secrets import find_secrets

    found = find_secrets(table(spark, folder, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["kind"] != "random")
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(joined_spans(base), 256).alias("base_sha256"),
        joined_spans(F.col("secrets")).alias("spans"),
        # What the randomness tests say of each span.
        F.transform("secrets", lambda s: F.struct(s["encoding"].alias("encoding"), s["p"].alias("p"))).alias("tests"),
    )


@query()
def op1_html_tree_model(spark: SparkSession, folder: str) -> DataFrame:
    from veilframe.llm.html_text import extract_text, train

    pages = table(spark, folder, "pages")
    found = extract_text(pages.select("page_id", "url", "html"), train(pages))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query(
    r"""
    WITH doc AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
    SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = min(doc_id) OVER same AS kept, sha256(t) AS text_sha256
    FROM doc WINDOW same AS (PARTITION BY t)
    """
)
def op11_chunk_recipes(spark: SparkSession, folder: str) -> DataFrame:
    from veilframe.llm.exact_copies import exact_copies

    found = exact_copies(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.col("keep").alias("keep_id"),
        F.col("size").alias("group_size"),
        "kept",
        F.col("digest").alias("text_sha256"),
    )


@query()
def op12_refined_whitening(spark: SparkSession, folder: str) -> DataFrame:
    from veilframe.llm.whitening import whiten

    return whiten(table(spark, folder, "embeddings"))


# A level of a tree is a list of nodes; each of its nodes is then a row, so that
# a document finds its sibling at every level by number.
@query(
    """
    WITH RECURSIVE
    cells AS (SELECT row_number() OVER () AS r, doc_id, lang, n_chars, CAST(doc_id AS VARCHAR) AS d,
                     coalesce('+' || lang, '') AS g,
                     coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
                     coalesce(strlen(text) || ':' || text, '-') AS tail
              FROM documents),
    crc AS (SELECT r, list_reduce(list_prepend(4294967295, list_transform(string_split(d, ''), c -> CAST(ascii(c) AS BIGINT))),
                                  (x, y) -> list_reduce(list_prepend(xor(x, y), [0, 0, 0, 0, 0, 0, 0, 0]),
                                                        (u, v) -> CASE WHEN u % 2 = 1 THEN xor(u // 2, 3988292384) ELSE u // 2 END))
                      AS c
            FROM cells WHERE d IS NOT NULL),
    leaves AS (SELECT cells.*, row_number() OVER (PARTITION BY g ORDER BY doc_id) - 1 AS p,
                      sha256(coalesce(strlen(d) || ':' || d, '-') || head
                             || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
                      sha256(coalesce(strlen(d) || ':' || d, '-') || head
                             || coalesce(strlen(CAST(m AS VARCHAR)) || ':' || m, '-') || tail) AS other
               FROM (SELECT cells.*, n_chars + CASE WHEN xor(c, 4294967295) % 7 = 0 THEN 1 ELSE 0 END AS m
                     FROM cells LEFT JOIN crc USING (r)) AS cells),
    level AS (SELECT g, 0 AS k, list(leaf ORDER BY p) AS nodes FROM leaves GROUP BY g
              UNION ALL
              SELECT g, k + 1, list_transform(range(1, len(nodes) + 1, 2), i -> sha256(nodes[i] || coalesce(nodes[i + 1], '')))
              FROM level WHERE len(nodes) > 1),
    sub AS (SELECT g, nodes[1] AS subroot, row_number() OVER (ORDER BY g) - 1 AS q FROM level WHERE len(nodes) = 1),
    top AS (SELECT 0 AS k, list(subroot ORDER BY q) AS nodes FROM sub
            UNION ALL
            SELECT k + 1, list_transform(range(1, len(nodes) + 1, 2), i -> sha256(nodes[i] || coalesce(nodes[i + 1], '')))
            FROM top WHERE len(nodes) > 1),
    node AS (SELECT g, k, unnest(range(len(nodes))) AS i, unnest(nodes) AS h FROM level WHERE len(nodes) > 1),
    high AS (SELECT k, unnest(range(len(nodes))) AS i, unnest(nodes) AS h FROM top WHERE len(nodes) > 1),
    low_step AS (SELECT r, l.k, (p >> l.k) % 2 AS odd, h
                 FROM leaves JOIN (SELECT DISTINCT g, k FROM node) l USING (g)
                 LEFT JOIN node ON node.g = l.g AND node.k = l.k AND node.i = xor(p >> l.k, 1)),
    high_step AS (SELECT r, 1000 + l.k AS k, (q >> l.k) % 2 AS odd, h
                  FROM leaves JOIN sub USING (g) CROSS JOIN (SELECT DISTINCT k FROM high) l
                  LEFT JOIN high ON high.k = l.k AND high.i = xor(q >> l.k, 1)),
    step AS (SELECT * FROM low_step UNION ALL SELECT * FROM high_step),
    proof AS (SELECT r, string_agg(coalesce(h, ''), '' ORDER BY k) AS siblings,
                     list(CASE WHEN odd = 1 THEN h || '*' ELSE '*' || coalesce(h, '') END ORDER BY k) AS steps
              FROM step GROUP BY r),
    done AS (SELECT doc_id, leaf, subroot, (SELECT nodes[1] FROM top WHERE len(nodes) = 1) AS root,
                    sha256(coalesce(siblings, '')) AS proof_sha256,
                    list_reduce(list_prepend(other, coalesce(steps, [])), (x, s) -> sha256(replace(s, '*', x))) AS folded_root
             FROM leaves JOIN sub USING (g) LEFT JOIN proof USING (r))
    SELECT *, folded_root = root AS verified FROM done
    """
)
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    from veilframe.llm.merkle import fold, manifest, siblings

    docs = table(spark, folder, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    one_more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    n_chars = F.when(tampered, one_more).otherwise(F.col("n_chars").cast("string"))
    found = manifest(docs, changed={"n_chars": n_chars})
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(siblings(F.col("proof")), 256).alias("proof_sha256"),
        fold(F.col("changed_leaf"), F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
