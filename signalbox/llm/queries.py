"""Queries of this package, one per operator, and their SQL where SQL expresses them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalbox.llm import (
    bitpack_ids,
    bitslice_topk,
    certified_packing,
    cube_mix,
    jaccard_join,
    license_scan,
    line_quality,
    merkle,
    packing,
    secret_forest,
    turn_repair,
    warc_chunks,
    wordpiece_count,
)
from signalbox.llm.common import landed, small_batches, table
from signalbox.llm.token_ids import vocabulary_path


def op1_warc_chunk_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as archives and read back through the chunk table."""
    return warc_chunks.archive_digests(spark, table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence places and labels per document."""
    return license_scan.scan_licenses(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


def op3_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 4096 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary_path("word_bpe_49k.json"))


def op4_bitslice_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products of every vector whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings")
    return bitslice_topk.top_k(vectors, vectors.filter(F.col("vec_id") % 20 == 0), k=20)


def op5_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality measures and verdicts of every document."""
    return line_quality.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "removed_words",
    )


def op6_wordpiece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word-piece counts of every document."""
    return wordpiece_count.count_pieces(table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"))


def op7_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents linked by 90 % Jaccard similarity of 3-word shingles."""
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=90)


def op8_bitpacked_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as bit-packed token ids, written and read back."""
    return bitpack_ids.packed_documents(
        spark, table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json")
    ).select("doc_id", "start", "n_tokens", "ids_crc32")


def op9_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the weights of their sources."""
    return cube_mix.mix(table(spark, sf_dir, "documents"))


def op10_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every secret candidate with the forest's verdict."""
    return secret_forest.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", "score", "is_secret"
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with faults planted by crc32 of ``conv_id:turn`` (nulls: one space)."""
    def filled(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(filled("text"), ".!?", "")).otherwise(filled("text"))
    rows = conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(filled("role")).alias("role"), text.alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )
    return rows.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("copies", "copy")


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations: faults, the cheapest repair and the checksum of the repaired turns."""
    given = table(spark, sf_dir, "conversations")
    rows = damaged(given)
    plans = landed(turn_repair.audits(rows, given.select("conv_id").distinct()), "turn-plans")
    sums = turn_repair.digests(rows, plans).select(F.col("conv_id").alias("id"), "repaired_sha256")
    return plans.join(sums, F.col("conv_id").eqNullSafe(F.col("id"))).drop("id")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof of membership, folded again from (partly tampered) rows."""
    tampered = F.when(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0,
        merkle.leaf_digest([F.translate(f, "\n", "") if f == "text" else F.col(f) for f in merkle.FIELDS]),
    )
    proven = merkle.manifest(table(spark, sf_dir, "documents"), carry={"tampered": F.unhex(tampered)})
    start = F.coalesce(F.lower(F.hex("tampered")), F.col("leaf"))
    return proven.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"),
        merkle.folded(start, F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_certified_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed whole into as few sequences of 2048 tokens as repacking finds."""
    return certified_packing.pack(table(spark, sf_dir, "documents"), vocabulary_path("word_bpe_49k.json"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (
        op1_warc_chunk_table, op2_license_scan, op3_sum_of_squares_packing, op4_bitslice_topk, op5_line_frequency,
        op6_wordpiece_counts, op7_jaccard_components, op8_bitpacked_ids, op9_cube_mix, op10_secret_forest, op11_turn_repair,
        op12_merkle_manifest, op13_certified_packing,
    )

    def bind(op):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            small_batches(spark)
            return op(spark, sf_dir)

        run.__name__, run.__doc__ = op.__name__, op.__doc__
        return run

    return {op.__name__: bind(op) for op in ops}


_OP1 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT html, min(page_id) AS first_id, sha1(html) AS hex, octet_length(encode(html)) AS n FROM p GROUP BY html)
SELECT page_id, n::BIGINT AS payload_bytes,
       list_reduce(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(hex, (1 + 5 * (i // 4))::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT + 1, 1)),
           lambda a, b: a || b) AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN NULL ELSE first_id END AS refers_to
FROM p JOIN g USING (html)
"""

_OP4 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS q FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0),
r AS (SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
             vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

_WORD = r"'[^\x20\x09-\x0D]+'"

_OP5 = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, {_WORD}) AS words FROM d),
l AS (SELECT row, source, text, unnest(string_split(text, chr(10))) AS line FROM d),
n AS (SELECT *, trim(regexp_replace(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[0-9]', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS norm,
             len(regexp_extract_all(line, {_WORD})) AS words FROM l),
docs_of AS (SELECT source, count(DISTINCT text) AS total FROM d GROUP BY source),
above AS (SELECT n.source, norm FROM n JOIN docs_of o ON n.source IS NOT DISTINCT FROM o.source
          WHERE norm <> '' GROUP BY n.source, norm
          HAVING count(DISTINCT text) > 10 AND count(DISTINCT text) > any_value(total) * 0.1),
removed AS (SELECT row, sum(words) AS removed_words FROM n JOIN above a
            ON n.source IS NOT DISTINCT FROM a.source AND n.norm = a.norm GROUP BY row),
dup AS (SELECT row, count(*) - count(DISTINCT line) AS n_dup_lines FROM n WHERE norm <> '' GROUP BY row),
t AS (SELECT row, i, words[i] || chr(10) || words[i + 1] || chr(10) || words[i + 2] AS gram
      FROM (SELECT row, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) > 2)),
twice AS (SELECT row, gram FROM t GROUP BY row, gram HAVING count(*) > 1),
covered AS (SELECT row, count(DISTINCT spot) AS n_repeat_words
            FROM (SELECT row, unnest([i, i + 1, i + 2]) AS spot FROM t SEMI JOIN twice USING (row, gram)) GROUP BY row),
m AS (SELECT w.doc_id, len(words) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(removed_words, 0)::BIGINT AS removed_words
      FROM w LEFT JOIN dup USING (row) LEFT JOIN covered USING (row) LEFT JOIN removed USING (row)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_words - removed_words >= 0.3 * n_words AS kept, removed_words FROM b
"""

_OP7 = rf"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS row, doc_id,
       regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          {_WORD}) AS words FROM documents),
s AS (SELECT DISTINCT row, md5(gram) AS gram FROM (
        SELECT row, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
        FROM (SELECT row, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) > 2)
        UNION ALL SELECT row, array_to_string(words, ' ') FROM w WHERE len(words) BETWEEN 1 AND 2)),
n AS (SELECT row, count(*) AS n FROM s GROUP BY row),
common AS (SELECT a.row AS a, b.row AS b, count(*) AS n_both FROM s a JOIN s b ON a.gram = b.gram AND a.row <> b.row
           GROUP BY a.row, b.row),
link AS (SELECT a, b FROM common c JOIN n x ON x.row = a JOIN n y ON y.row = b
         WHERE 100 * n_both >= 90 * (x.n + y.n - n_both)),
reach(a, b) AS (SELECT row, row FROM w UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
least AS (SELECT r.a AS row, min(w.doc_id) AS component_id FROM reach r JOIN w ON w.row = r.b GROUP BY r.a),
degree AS (SELECT a AS row, count(*) AS n_links FROM link GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, coalesce(n_links, 0) AS n_links
FROM w JOIN least USING (row) LEFT JOIN n USING (row) LEFT JOIN degree USING (row)
"""


def _edit(state: str, letter: str, cost) -> str:
    """A state's text, nine digits of cost and then the edits, after one more edit."""
    return f"(lpad((substr({state}, 1, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || substr({state}, 10) || '{letter}')"


def _least(*states: str) -> str:
    return f"least({', '.join(states)})"


_AFTER_INSERTS = f"""y0 AS x0, y1 AS x1, y2 AS x2, {_least('y3', _edit('y2', 'I', 2))} AS x3
    FROM (SELECT *, x0 AS y0, x1 AS y1, {_least('x2', *(_edit(x, 'I', 2) for x in ('x0', 'x1', 'x3')))} AS y2, x3 AS y3
"""

_OP11 = f"""
WITH RECURSIVE keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
       coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
crc AS (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda c: ord(c)::BIGINT)),
       lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
                                lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20 AS kind FROM keyed),
damaged AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
       CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
       unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM crc WHERE kind <> 0),
c AS (SELECT row_number() OVER (ORDER BY conv_id NULLS FIRST) AS conv, conv_id FROM (SELECT DISTINCT conv_id FROM conversations)),
r AS (SELECT c.conv, d.turn, d.role, d.text, substr(d.role, 1, 1) AS i,
       row_number() OVER (PARTITION BY c.conv ORDER BY turn NULLS FIRST, d.role, sha256(text)) AS n,
       rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
       FROM damaged d JOIN c ON d.conv_id IS NOT DISTINCT FROM c.conv_id),
q AS (SELECT *, row_number() OVER (PARTITION BY conv, role, text ORDER BY n) AS again FROM r),
f AS (SELECT *, CASE WHEN bare = '' THEN 1 WHEN again > 1 THEN 2 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
       lag(i) OVER (PARTITION BY conv ORDER BY n) AS before FROM q),
m AS (SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 1)::BIGINT AS blank,
       count_if(fault = 2)::BIGINT AS duplicate, count_if(fault = 3)::BIGINT AS truncated,
       count_if(before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au'))::BIGINT AS illegal FROM f GROUP BY conv),
walk AS (SELECT conv, 0::BIGINT AS n, '000000000' AS x0, NULL::VARCHAR AS x1, NULL::VARCHAR AS x2, NULL::VARCHAR AS x3 FROM c
  UNION ALL
  SELECT w.conv, f.n, {_edit('x0', 'D', 3)},
    {_least(_edit('x1', 'D', 3), "CASE WHEN live AND i = 's' THEN " + _edit('x0', 'K', 'late') + " END")},
    {_least(_edit('x2', 'D', 3),
            *("CASE WHEN live AND i = 'u' THEN " + _edit(x, 'K', 'late') + " END" for x in ('x0', 'x1', 'x3')),
            *("CASE WHEN live THEN " + _edit(x, 'R', '2 + late') + " END" for x in ('x0', 'x1', 'x3')))},
    {_least(_edit('x3', 'D', 3), "CASE WHEN live AND i = 'a' THEN " + _edit('x2', 'K', 'late') + " END",
            "CASE WHEN live THEN " + _edit('x2', 'R', '2 + late') + " END")}
  FROM (SELECT conv, n, {_AFTER_INSERTS} FROM walk)) w
  JOIN (SELECT conv, n, i, fault NOT IN (1, 2) AS live, (fault = 3)::BIGINT AS late FROM f) f ON f.conv = w.conv AND f.n = w.n + 1),
best AS (SELECT conv, least(x0, x3) AS x FROM (SELECT conv, n, {_AFTER_INSERTS} FROM walk))
         QUALIFY row_number() OVER (PARTITION BY conv ORDER BY n DESC) = 1),
a AS (SELECT conv, substr(x, 1, 9)::BIGINT AS cost, substr(x, 10) AS audit FROM best),
e AS (SELECT conv, spot, substr(audit, spot, 1) AS edit FROM (SELECT conv, audit, unnest(range(1, len(audit) + 1)) AS spot FROM a)),
o AS (SELECT *, count_if(edit <> 'I') OVER (PARTITION BY conv ORDER BY spot) AS n,
       count_if(edit <> 'D') OVER (PARTITION BY conv ORDER BY spot) AS place FROM e),
s AS (SELECT o.conv, o.spot, o.edit, o.place, f.role, CASE o.edit WHEN 'I' THEN '' ELSE f.text END AS text,
       max(CASE WHEN o.place = 1 AND o.edit = 'K' AND f.i = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY o.conv) AS lead
      FROM o LEFT JOIN f ON f.conv = o.conv AND f.n = o.n WHERE o.edit <> 'D'),
h AS (SELECT conv, string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - lead) % 2 = 1 THEN 'user' ELSE 'assistant' END
       || ':' || text, chr(10) ORDER BY spot) AS body FROM s GROUP BY conv)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost, audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM c JOIN a USING (conv) LEFT JOIN m USING (conv) LEFT JOIN h USING (conv)
"""


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::VARCHAR)) || ':' || {value}::VARCHAR, '-')"


_LEAF = "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"


def _tree(name: str, leaves: str, tree: str) -> str:
    """Nodes of all trees below ``tree`` and, for each below a root, the digests left and right of it."""
    return f"""
{name} AS (SELECT {tree} AS tree, 0 AS level, idx, leaf AS digest, n FROM {leaves} UNION ALL
  SELECT tree, level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (n + 2) // 3 FROM {name}
  WHERE n > 1 GROUP BY tree, level, idx // 3, n),
{name}_sides AS (SELECT tree, level, idx,
    coalesce(string_agg(digest, '') OVER (PARTITION BY tree, level, idx // 3 ORDER BY idx
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(digest, '') OVER (PARTITION BY tree, level, idx // 3 ORDER BY idx
             ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after FROM {name} WHERE n > 1)"""


_OP12 = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS row, doc_id, source, {_LEAF.replace('{text}', 'text')} AS leaf,
    {_LEAF.replace('{text}', "replace(text, chr(10), '')")} AS cut,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
       lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
                                lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 2 AS odd FROM documents),
leaves AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY source) AS n FROM d),
{_tree('low', 'leaves', 'tree')},
subroots AS (SELECT tree AS idx, digest AS leaf, count(*) OVER () AS n FROM low WHERE n = 1),
{_tree('high', 'subroots', '0')},
climb AS (SELECT row, tree, 0 AS level, idx, CASE WHEN odd = 0 THEN cut ELSE leaf END AS digest, '' AS proof FROM leaves UNION ALL
  SELECT row, c.tree, c.level + 1, c.idx // 3, sha256(s.before || c.digest || s.after), proof || s.before || s.after
  FROM climb c JOIN low_sides s ON s.tree = c.tree AND s.level = c.level AND s.idx = c.idx),
low_end AS (SELECT * FROM climb QUALIFY row_number() OVER (PARTITION BY row ORDER BY level DESC) = 1),
over AS (SELECT row, 0 AS level, tree AS idx, digest, proof FROM low_end UNION ALL
  SELECT row, c.level + 1, c.idx // 3, sha256(s.before || c.digest || s.after), proof || s.before || s.after
  FROM over c JOIN high_sides s ON s.level = c.level AND s.idx = c.idx),
high_end AS (SELECT * FROM over QUALIFY row_number() OVER (PARTITION BY row ORDER BY level DESC) = 1)
SELECT l.doc_id, l.leaf, u.leaf AS subroot, r.digest AS root, sha256(e.proof) AS proof_sha256, e.digest AS folded_root,
       e.digest = r.digest AS verified
FROM leaves l JOIN subroots u ON u.idx = l.tree JOIN (SELECT digest FROM high WHERE n = 1) r ON TRUE JOIN high_end e USING (row)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_warc_chunk_table": _OP1,
        "op4_bitslice_topk": _OP4,
        "op5_line_frequency": _OP5,
        "op7_jaccard_components": _OP7,
        "op11_turn_repair": _OP11,
        "op12_merkle_manifest": _OP12,
    }
