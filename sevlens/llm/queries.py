"""Registered queries of the dealt operators: thin digests over the operators' own results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sevlens.llm import (decontaminate, embedding_dedup, jaccard_join, language, licenses, merkle, mixing, oracle, prefix_trie, repeats, secrets, substrings,
                         token_output, toxicity)
from sevlens.llm.common import held_out, read, stored
from sevlens.session import scratch_path


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    groups, targets = mixing.mix(docs, (3, 1, 2), 1.5, 2)
    t = targets.select(F.col("source").alias("_t"), "source_size", "target")
    return (mixing.with_copies(docs.select("doc_id", "source", "text"), groups, "size", "copies").drop("text")
            .join(t, F.col("source").eqNullSafe(F.col("_t")))
            .select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"))
    model = language.fit(docs.where(~out))
    return language.predict(docs, model).select("doc_id", out.alias("held_out"), "lang_pred", "score", "rejected")


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = scratch_path(spark, "tokens")
    shards = stored(token_output.with_bases(token_output.write_tokens(
        read(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"), 50257)), "shards")
    return token_output.read_tokens(shards, folder, 50257)


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read(spark, sf_dir, "embeddings"), 0.9)


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_documents(read(spark, sf_dir, "documents"))
    text = lambda kinds: F.concat_ws(",", F.transform(
        F.filter("spans", lambda s: s["kind"].isin(*kinds)), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(text(("assign", "access", "hex")), 256).alias("base_sha256"),
                        text(secrets.KINDS).alias("spans"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.fit(toxicity.labelled(docs, read(spark, sf_dir, "labels")))
    return toxicity.score(docs.select("doc_id", "text"), model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                              (F.col("score") >= 0.7).cast("int").alias("predicted"), "evidence")


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(read(spark, sf_dir, "documents")).drop("id", "text_hash")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.kept_bytes(repeats.with_repeats(read(spark, sf_dir, "documents"), 100))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.proofs(read(spark, sf_dir, "documents"))


def op12_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.kept_words(substrings.with_repeats(read(spark, sf_dir, "documents"), 50))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie_nodes(prefix_trie.rebuilt(read(spark, sf_dir, "conversations")))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_language": op2_language,
    "op3_token_output": op3_token_output,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_secrets": op5_secrets,
    "op6_toxicity": op6_toxicity,
    "op7_licenses": op7_licenses,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_decontaminate": op9_decontaminate,
    "op10_repeats": op10_repeats,
    "op11_merkle": op11_merkle,
    "op12_substrings": op12_substrings,
    "op13_prefix_trie": op13_prefix_trie,
}

#: The words of a text, as in the contract of operator 9.
_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

_KNOWN = "[" + ", ".join(f"'{s}'" for s in licenses.SENTENCES) + "]"


def _sentences(end: str) -> str:
    return f"""list_filter(list_transform(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{end}'),
        lambda s: coalesce(list_position({_KNOWN}, regexp_replace(trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g')),
                                         '{licenses.HOLDER}', '{licenses.ANY_HOLDER}')), 0)), lambda i: i > 0)"""


def _held(cut: str) -> str:
    """Columns of the rules that hold in a cut: each sees the line without what the longer ones before it have used up."""
    lines = [f"array_to_string(list_transform(list_filter({cut}, lambda i: i <> {licenses.WEAK[1]}), lambda i: concat(',', i, ',')), '') AS {cut}_0"]
    lines += [f"replace({cut}_{n}, '{licenses.key(r)}', ',0,') AS {cut}_{n + 1}" for n, (_, r) in enumerate(licenses.RULES)]
    found = ", ".join(f"CASE WHEN contains({cut}_{n}, '{licenses.key(r)}') THEN '{name}' END" for n, (name, r) in enumerate(licenses.RULES))
    return ", ".join([*lines, f"list_filter([{found}], lambda x: x IS NOT NULL) AS {cut}_names"])


def _whole(own: str, other: str) -> str:
    fuller = " OR ".join(f"x = '{short}' AND list_contains({other}, '{long}') AND NOT list_contains({own}, '{long}')" for short, long in licenses.WITHIN)
    return f"list_filter({own}, lambda x: NOT ({fuller}))"


ORACLE_SQL: dict[str, str] = {
    "op7_licenses": f"""
        WITH cuts AS (SELECT doc_id, {_sentences(licenses.LINE_END)} AS a, {_sentences(licenses.MARK_END)} AS b FROM documents),
        held AS (SELECT doc_id, a, b, {_held("a")}, {_held("b")} FROM cuts),
        named AS (SELECT *, list_sort(list_distinct(list_concat({_whole("a_names", "b_names")}, {_whole("b_names", "a_names")}))) AS names FROM held)
        SELECT doc_id, coalesce(array_to_string(a, ','), '') AS sentence_ids,
          CASE WHEN len(names) = 0 AND (list_contains(a, {licenses.WEAK[1]}) OR list_contains(b, {licenses.WEAK[1]})) THEN '{licenses.WEAK[0]}'
               ELSE coalesce(array_to_string(names, ','), '') END AS licenses
        FROM named""",
    "op4_embedding_dedup": """
        WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        ok AS (SELECT vec_id, e FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                                         AND len(list_filter(e, lambda x: x <> 0)) > 0),
        links AS (SELECT a.vec_id AS u, b.vec_id AS v FROM ok a JOIN ok b ON a.vec_id <> b.vec_id
                  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
        reach AS (SELECT u, v FROM links UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u),
        low AS (SELECT u, min(v) AS m FROM reach GROUP BY u), n AS (SELECT u, count(*) AS n FROM links GROUP BY u)
        SELECT vec_id, coalesce(n.n, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id,
               vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
        FROM v LEFT JOIN low ON low.u = vec_id LEFT JOIN n ON n.u = vec_id""",
    "op9_decontaminate": f"""
        WITH i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        win AS (SELECT DISTINCT item_id, w[s:s + 12] AS win
                FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
        d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        sizes AS (SELECT DISTINCT len(win) AS size FROM win),
        dw AS (SELECT doc_id, s, size, w[s:s + size - 1] AS win
               FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM d, sizes)),
        hit AS (SELECT doc_id, s, size, item_id FROM dw JOIN win USING (win)),
        covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit
                    FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM hit) GROUP BY doc_id),
        found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
                  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op11_merkle": oracle.MERKLE,
    "op12_substrings": oracle.SUBSTRINGS,
    "op13_prefix_trie": oracle.PREFIX_TRIE,
}
