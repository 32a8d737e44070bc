"""Driver queries of the training-data operators: thin digests over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tamarind.llm import (ann, bag_minhash, bpe, centroids, chat, decontaminate, html_extract, language_id, license_scan,
                          merkle, quality, toxicity, warc)
from tamarind.llm.common import crc_mod


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Vocabulary files; the paths are parameters of the operators.
BPE_FILE = public_tokenizers.path("byte_bpe_50k.json")
PIECES_FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _joined(c):
    return F.array_join(c, ",")


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bag_minhash.near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_mod(F.col("doc_id"), 5) == 0
    model = quality.learn(docs, _table(spark, sf_dir, "labels"), ~held_out)
    return quality.score(docs, model, keep=["doc_id"]).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out = bpe.bpe_encode(docs, BPE_FILE, keep=["doc_id"], decode=True)
    return out.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
                      F.sha2(_joined(F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    model = language_id.learn(docs, PIECES_FILE, ~held_out)
    return (language_id.identify(docs, model, keep=["doc_id"])
            .select("doc_id", held_out.alias("held_out"), "lang_pred", "score"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate.decontaminate(docs, _table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(_joined("items"), 256).alias("items_sha256"), "contaminated")


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    out = chat.read_back(chat.format_chats(rows.unionByName(probe), BPE_FILE), BPE_FILE)
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
                      F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"))


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.search(vectors, lambda i: i % 50 == 0)


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages"), keep=["page_id", "url"])


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license_scan.scan_licenses(_table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", _joined("base_labels").alias("base_labels"),
                      _joined("labels").alias("labels"), _joined("expressions").alias("expressions"), "restriction", "score")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    machine = toxicity.learn(docs, _table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(docs, machine, keep=["doc_id"]).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.archive_pages(_table(spark, sf_dir, "pages"))
    return out.select(F.nullif("record_id", F.lit("")).cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                      F.col("refers_to").cast("long").alias("refers_to"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = centroids.cluster(_table(spark, sf_dir, "embeddings"))
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                      F.sha2(_joined(F.col("centroid").cast("array<string>")), 256).alias("centroid_sha256"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = merkle.manifest(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")


QUERIES = {
    "op1_near_duplicates": op1_near_duplicates,
    "op2_quality": op2_quality,
    "op3_bpe": op3_bpe,
    "op4_language_id": op4_language_id,
    "op5_decontaminate": op5_decontaminate,
    "op6_chat_format": op6_chat_format,
    "op7_nearest": op7_nearest,
    "op8_html_extract": op8_html_extract,
    "op9_license_scan": op9_license_scan,
    "op10_toxicity": op10_toxicity,
    "op11_warc": op11_warc,
    "op12_centroids": op12_centroids,
    "op13_merkle": op13_merkle,
    "pipeline": corpus_pipeline.run,
}


def _clusters_sql(k: int = 8, dim: int = 64, rounds: int = 10) -> str:
    """The rounds of op12 one after the other, by plain comparison with every centroid."""
    steps = [f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, [cast(floor(1024 * cast(c AS DOUBLE)) AS BIGINT) FOR c IN embedding] AS x
  FROM embeddings WHERE len(embedding) = {dim} AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, x) - 1 AS c, x FROM v QUALIFY c < {k})"""]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT v.r, any_value(v.x) AS x,
  min({{'d': list_sum([cast((p[1] - p[2]) * (p[1] - p[2]) AS HUGEINT) FOR p IN list_zip(v.x, c.x)]), 'c': c.c}}) AS m FROM v, c{r} c GROUP BY v.r)""")
        if r < rounds:
            steps.append(f"""s{r} AS (SELECT m.c AS c, i, sum(x[i]) AS s, count(*) AS n FROM a{r}, range(1, {dim + 1}) t(i) GROUP BY ALL),
c{r + 1} AS MATERIALIZED (SELECT c.c, coalesce(n.x, c.x) AS x FROM c{r} c
  LEFT JOIN (SELECT c, list(cast((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM s{r} GROUP BY c) n USING (c))""")
    return f"""WITH {", ".join(steps)}
SELECT v.vec_id, cast(a.m.c AS INTEGER) AS cluster, cast(a.m.d AS BIGINT) AS distance,
       cast(sum(a.m.d) OVER (PARTITION BY a.m.c) AS BIGINT) AS cluster_inertia, cast(sum(a.m.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM v JOIN a{rounds} a USING (r) JOIN c{rounds} c ON c.c = a.m.c"""


def _merkle_sql(levels: int = 6, run: int = 16) -> str:
    """The trees of op13 level by level, for sources of up to run ** levels rows; crc32 by its polynomial."""
    def field(c):
        return f"coalesce(octet_length(encode(cast({c} AS VARCHAR))) || ':' || {c}, '-')"

    def tree(name, first, key):
        """Levels 0 to ``levels`` of the trees of ``first`` (key, pos, width, hash); a row whose tree has one node is its top."""
        steps = [f"{name}0 AS MATERIALIZED ({first})"]
        for l in range(levels):
            steps.append(f"""{name}{l + 1} AS MATERIALIZED (SELECT {key}, pos // {run} AS pos, (width + {run - 1}) // {run} AS width,
  CASE WHEN any_value(width) = 1 THEN any_value(hash) ELSE sha256(string_agg(hash, '' ORDER BY pos)) END AS hash,
  CASE WHEN any_value(width) = 1 THEN [] ELSE list(hash ORDER BY pos) END AS run FROM {name}{l} GROUP BY {key}, pos // {run}, (width + {run - 1}) // {run})""")
        return steps

    steps = [f"""d AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
  count(*) OVER (PARTITION BY source) AS width FROM (SELECT doc_id, source,
    sha256(concat({", ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))})) AS leaf,
    CASE WHEN xor(list_reduce([cast(ascii(c) AS BIGINT) FOR c IN string_split(coalesce(cast(doc_id AS VARCHAR), ''), '') IF c <> ''],
      lambda a, b: list_reduce(range(0, 8), lambda h, i: CASE WHEN h & 1 = 1 THEN xor(h >> 1, 3988292384) ELSE h >> 1 END, xor(a, b)),
      4294967295), 4294967295) % 5 = 0
    THEN sha256(concat({", ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))},
      {field("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")})) END AS changed FROM documents))"""]
    steps += tree("t", "SELECT source, pos, width, leaf AS hash, [] AS run FROM d", "source")
    steps.append(f"""subs AS MATERIALIZED (SELECT source, hash AS subroot, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS upos,
  count(*) OVER () AS uwidth FROM t{levels})""")
    steps += tree("u", "SELECT 0 AS k, upos AS pos, uwidth AS width, subroot AS hash, [] AS run FROM subs", "k")
    joins = "".join(f" JOIN t{l} ON t{l}.source IS NOT DISTINCT FROM d.source AND t{l}.pos = d.pos // {run ** l}" for l in range(1, levels + 1))
    joins += " JOIN subs ON subs.source IS NOT DISTINCT FROM d.source"
    joins += "".join(f" JOIN u{l} ON u{l}.pos = subs.upos // {run ** l}" for l in range(1, levels + 1))
    places = [(f"t{l}.run", f"(d.pos // {run ** (l - 1)}) % {run}") for l in range(1, levels + 1)]
    places += [(f"u{l}.run", f"(subs.upos // {run ** (l - 1)}) % {run}") for l in range(1, levels + 1)]
    path = ", ".join(f"{{'r': {r}, 'i': {i}}}" for r, i in places)
    steps.append(f"""p AS MATERIALIZED (SELECT d.doc_id, d.leaf, subs.subroot, u{levels}.hash AS root, coalesce(d.changed, d.leaf) AS start,
  [{{'a': array_to_string(s.r[1:s.i], ''), 'b': array_to_string(s.r[s.i + 2:], '')}} FOR s IN [{path}] IF len(s.r) > 0] AS path FROM d{joins})""")
    return f"""WITH {", ".join(steps)}
SELECT doc_id, leaf, subroot, root, sha256(array_to_string([s.a || s.b FOR s IN path], '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM (SELECT *, list_reduce(path, lambda h, s: {{'a': sha256(s.a || h.a || s.b), 'b': ''}}, {{'a': start, 'b': ''}}).a AS folded_root FROM p)"""


# control strings of any template in a text get one mark more, so one character more
_CONTROL = (r"<\\*\|start\|>|<\\*\|message\|>|<\\*\|end\|>|<\\*\|endoftext\|>|<\\*\|im_start\|>|<\\*\|im_end\|>"
            r"|<\\*s>|<\\*/s>|\[\\*INST\]|\[\\*/INST\]|<\\*<SYS>>|<\\*</SYS>>")

ORACLES = {
    # a turn is its role, its text and 27 characters of control strings (9 + 11 + 7)
    "op6_chat_format": rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       cast(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
       cast(sum(length(role) + length(text) + 27 + len(regexp_extract_all(role, '{_CONTROL}'))
                + len(regexp_extract_all(text, '{_CONTROL}'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
""",
    # words and windows by plain SQL: every place of a window, then its words
    "op5_decontaminate": r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
bw AS (SELECT item_id, w, least(10, len(w)) AS k FROM b WHERE len(w) > 0 AND item_id IS NOT NULL),
win AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s
        FROM (SELECT item_id, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM bw)),
ks AS (SELECT DISTINCT k FROM win),
dw AS (SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
       FROM (SELECT d.r, d.w, ks.k, unnest(range(1, len(d.w) - ks.k + 2)) AS i FROM d, ks)),
hit AS (SELECT dw.r, dw.i, dw.k, win.item_id FROM dw JOIN win ON dw.k = win.k AND dw.s = win.s),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS s
          FROM (SELECT DISTINCT r, cast(item_id AS VARCHAR) AS x FROM hit) GROUP BY r)
SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
""",
    # base32: every five hexadecimal digits are four digits of five bits
    "op11_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
s AS (SELECT page_id, octet_length(encode(h)) AS n, sha1(h) AS x FROM p),
r AS (SELECT *, max(page_id) OVER (PARTITION BY x) AS m FROM s)
SELECT page_id, cast(n AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast((cast('0x' || substr(x, 5 * (i // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER) + 1, 1)
                        FOR i IN range(0, 32)], '') AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM m THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM m THEN m END AS refers_to
FROM r
""",
    "op12_centroids": _clusters_sql(),
    "op13_merkle": _merkle_sql(),
}
