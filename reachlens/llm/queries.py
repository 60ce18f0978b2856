"""The numbered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reachlens.llm import (chat, decontaminate, html_text, manifest, merkle, mixing, quality, repair, setsketch,
                           substring, token_files, url_filter, warc)
from reachlens.llm.common import scratch, written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    warc.write_archive(_table(spark, sf_dir, "pages"), path)
    return warc.resolved(written(warc.index(warc.read_archive(spark, path)), "warc-index"))


#: 20 bits of the digest at a time: four letters of base 32
OP2_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
    sha1(coalesce(html, '')) AS hex FROM pages
), d AS (
  SELECT page_id, payload_bytes, list_aggregate(list_transform(range(32), lambda i: substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((CAST('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS INT), 5)
      AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31) AS INT), 1)), 'string_agg', '') AS payload_digest
  FROM p
), r AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to FROM r
"""


def op3_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = merkle.edited_fingerprints(_table(spark, sf_dir, "documents"))
    own = F.col("fingerprint")
    return made.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint",
        merkle.likeness(own, F.col("edited_fingerprint")).alias("near_edited"),
        merkle.likeness(own, F.col("next_fingerprint")).alias("near_next"))


OP3_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(
    lead(coalesce(text, '')) OVER (ORDER BY doc_id DESC),
    first(coalesce(text, '')) OVER (ORDER BY doc_id DESC)) AS next FROM documents
), e AS (
  SELECT doc_id, text, left(text, length(text) - length(text) // 3)
    || CASE WHEN length(text) < 3 THEN '' ELSE left(next, length(text) // 3) END AS edited FROM d
), t AS (
  SELECT doc_id, 0 AS kind, text FROM e UNION ALL SELECT doc_id, 1, edited FROM e
), n AS (
  SELECT doc_id, kind, text, list_transform(string_split(text, chr(10)), lambda p: list_transform(list_filter(
    string_split(array_to_string(list_transform(regexp_extract_all(p, '{merkle.WORD}'), lambda w:
      w || CASE WHEN md5(ltrim(w, ' ' || chr(9) || chr(13) || chr(12) || chr(11)))[1] IN ('0', '1') THEN chr(10)
        ELSE '' END), ''), chr(10)), lambda r: r <> ''), lambda r: sha256(r))) AS runs FROM t
), h AS (
  SELECT doc_id, kind, text, list_transform(runs, lambda p: sha256(coalesce(array_to_string(p, ''), ''))) AS hashes,
    list_transform(flatten(runs), lambda x: substr(x, 1, {merkle.LEAF})) AS leaves FROM n
), s AS (
  SELECT *, list_transform(string_split(rtrim(array_to_string(list_transform(hashes,
    lambda x: CASE WHEN x[1] IN ('0', '1', '2', '3') THEN x || ';' ELSE x END), ''), ';'), ';'),
    lambda x: sha256(x)) AS sections FROM h
), f AS (
  SELECT doc_id, kind, text, leaves, sha256(array_to_string(sections, '')) AS root, concat_ws(':',
    sha256(array_to_string(sections, '')),
    array_to_string(list_transform(sections, lambda x: substr(x, 1, {merkle.CUT})), ','),
    array_to_string(list_transform(hashes, lambda x: substr(x, 1, {merkle.CUT})), ','),
    array_to_string(leaves, ',')) AS fp FROM s
), j AS (
  SELECT a.doc_id, a.text, a.leaves, a.root, a.fp, b.fp AS edited_fp, b.text AS edited, b.root AS edited_root,
    b.leaves AS edited_leaves,
    coalesce(lead(a.root) OVER (ORDER BY a.doc_id DESC), first(a.root) OVER (ORDER BY a.doc_id DESC)) AS next_root,
    coalesce(lead(a.leaves) OVER (ORDER BY a.doc_id DESC), first(a.leaves) OVER (ORDER BY a.doc_id DESC)) AS next_leaves
  FROM f a JOIN f b USING (doc_id) WHERE a.kind = 0 AND b.kind = 1
)
SELECT doc_id, length(text) AS n_chars, sha256(edited) AS edited_sha256, fp AS fingerprint,
  edited_fp AS edited_fingerprint,
  CAST(CASE WHEN root = edited_root THEN 1 WHEN len(leaves) + len(edited_leaves) = 0 THEN 0 ELSE
    CAST(2 * len(list_intersect(leaves, edited_leaves)) AS DOUBLE)
    / (len(list_distinct(leaves)) + len(list_distinct(edited_leaves))) END AS DOUBLE) AS near_edited,
  CAST(CASE WHEN root = next_root THEN 1 WHEN len(leaves) + len(next_leaves) = 0 THEN 0 ELSE
    CAST(2 * len(list_intersect(leaves, next_leaves)) AS DOUBLE)
    / (len(list_distinct(leaves)) + len(list_distinct(next_leaves))) END AS DOUBLE) AS near_next
FROM j
"""


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(_table(spark, sf_dir, "documents"))


OP4_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(words[p + 1:p + 3], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(greatest(1, len(words) - 2))) AS p FROM d WHERE len(words) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b USING (shingle)
  WHERE a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
r AS (SELECT doc_id AS node, doc_id AS seen FROM documents UNION SELECT r.node, l.b FROM r JOIN l ON l.a = r.seen),
c AS (SELECT node AS doc_id, min(seen) AS component_id FROM r GROUP BY node)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
"""


def op5_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring.without_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    joined = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return kept.select("doc_id", F.col("_n_words").alias("n_words"), F.col("_n_removed").alias("n_removed"),
                       F.sha2(joined.cast("binary"), 256).alias("kept_sha256"))


OP5_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (SELECT doc_id, p, md5(array_to_string(words[p + 1:p + {substring.WINDOW}], ' ')) AS hash
  FROM (SELECT *, unnest(range(len(words) - {substring.WINDOW - 1})) AS p FROM d)),
r AS (SELECT doc_id, p FROM w WHERE hash IN (SELECT hash FROM w GROUP BY hash HAVING count(*) > 1)),
c AS (SELECT DISTINCT doc_id, p + i AS at FROM r, range({substring.WINDOW}) x(i)),
k AS (SELECT a.doc_id, a.p, a.word FROM (SELECT doc_id, unnest(range(len(words))) AS p, unnest(words) AS word FROM d) a
  ANTI JOIN c ON a.doc_id = c.doc_id AND a.p = c.at),
t AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text FROM k GROUP BY doc_id)
SELECT d.doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed,
  sha256(coalesce(t.text, '')) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)
"""


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    bad = written(decontaminate.contaminated(docs, _table(spark, sf_dir, "benchmark")), "contaminated")
    return docs.select("doc_id").join(bad, "doc_id", "left").select(
        "doc_id", F.col("item_ids").isNotNull().alias("contaminated"),
        F.coalesce(F.array_join(F.col("item_ids").cast("array<string>"), ","), F.lit("")).alias("item_ids"))


# without seeds: all positions where a document's and an item's tokens are equal, by diagonal
OP7_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+') AS words
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+') AS item FROM benchmark
), i AS (SELECT row_number() OVER () AS nr, item_id, len(item) AS n, least(len(item), {decontaminate.WINDOW}) AS width,
  unnest(item) AS word, unnest(range(len(item))) AS at FROM b),
w AS (SELECT row, doc_id, unnest(words) AS word, unnest(range(len(words))) AS p FROM d),
x AS (
  SELECT doc_id, item_id, width, list(i.at) AS same FROM w JOIN i USING (word)
  GROUP BY row, doc_id, nr, item_id, width, p - i.at
  HAVING count(*) >= CAST({decontaminate.SIMILARITY} AS DOUBLE) * width
), h AS (
  SELECT DISTINCT doc_id, item_id FROM x WHERE list_bool_or(list_transform(same, lambda a:
    len(list_filter(same, lambda j: j BETWEEN a AND a + width - 1)) >= CAST({decontaminate.SIMILARITY} AS DOUBLE) * width))
), g AS (SELECT doc_id, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS item_ids FROM h GROUP BY doc_id)
SELECT doc_id, item_ids IS NOT NULL AS contaminated, coalesce(item_ids, '') AS item_ids
FROM documents LEFT JOIN g USING (doc_id)
"""


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(_table(spark, sf_dir, "documents"))


OP9_SQL = f"""
WITH d AS (SELECT *, coalesce(source, chr(2)) AS src, coalesce(CAST(doc_id AS VARCHAR), 'null') AS id FROM documents),
s AS (SELECT src, sum(length(coalesce(text, ''))) AS chars FROM d GROUP BY src),
t AS (SELECT src, chars, sqrt(chars) AS target FROM s),
r AS (SELECT src, CASE WHEN chars > 0 THEN target / sum(target) FILTER (chars > 0) OVER ()
    * CAST(sum(chars) OVER () AS DOUBLE) / chars ELSE 1.0 END AS rate FROM t),
q AS (SELECT src, greatest(1, CAST(ceil(rate / {mixing.PART}) AS INT)) AS parts, rate FROM r),
c AS (SELECT src, parts, k, sum(exp(-rate / parts) * pow(rate / parts, k) / factorial(CAST(k AS INT)))
    OVER (PARTITION BY src ORDER BY k) AS step FROM q, range(34) n(k)),
u AS (SELECT d.*, CAST(CAST('0x' || substr(md5('{mixing.SEED}|' || id || '|' || j), 1, 13) AS BIGINT) AS DOUBLE)
    / 4503599627370496.0 AS draw FROM d JOIN q USING (src), range(1, 50) m(j) WHERE j <= parts),
n AS (SELECT u.doc_id, count(*) AS copies FROM u JOIN c ON u.src = c.src AND c.step <= u.draw GROUP BY u.doc_id)
SELECT doc_id, text, lang, source, n_chars, CAST(x AS INT) AS copy,
  substr(md5('{mixing.SEED}|order|' || id || '|' || x), 1, 16) AS order_key
FROM d JOIN n USING (doc_id), range(1, 1000) z(x) WHERE x <= copies
"""


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"))


#: a conversation whose texts hold the template's own strings
PROBE = (-7, r"\### Assistant: </turn> ok")


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(PROBE[0], 0, "user", PROBE[1]), (PROBE[0], 1, "assistant", PROBE[1])],
                                  "conv_id bigint, turn bigint, role string, text string")
    return chat.read_back(written(chat.prefix_tree_packs(rows.unionByName(probe)), "packs"))


OP10_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
  SELECT *, 15 + 2 * (length(role) + length(text))
    - length(replace(replace(replace(role, '\', ''), '<', ''), chr(10), ''))
    - length(replace(replace(text, '\', ''), '<', '')) AS chars FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    path = scratch(spark, "tokens")
    token_files.write_tokens(_table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read_documents(spark, path)


def _crc_sql(text: str) -> str:
    """CRC-32 of an ASCII string, bit by bit."""
    byte = "list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), " \
        "lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))"
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), "
            f"lambda c: ord(c)::BIGINT)), lambda a, b: {byte}))")


def _leaf_sql(text: str) -> str:
    fields = [f"CAST({c} AS VARCHAR)" for c in ("doc_id", "source", "lang", "n_chars")] + [text]
    return "sha256(" + " || ".join(
        f"coalesce(octet_length(encode({f})) || ':' || {f}, '-')" for f in fields) + ")"


def _climb_sql(nodes: str) -> str:
    """The levels of trees of three children: tree, lvl, pos, n, h."""
    return (f"SELECT tree, 0 AS lvl, pos, n, h FROM {nodes[0]} UNION ALL "
            f"SELECT tree, lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM {nodes[1]} "
            "WHERE n > 1 GROUP BY tree, lvl, pos // 3, n")


#: one step up: the node among its run's others, which go to the proof
_STEP_SQL = """f.lvl + 1, f.pos // 3, sha256(array_to_string(hs[:f.pos % 3] || [f.h] || hs[f.pos % 3 + 2:], '')),
    proof || array_to_string(hs[:f.pos % 3] || hs[f.pos % 3 + 2:], '')"""

OP12_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(':' || source, '-') AS tree, {_leaf_sql("text")} AS leaf,
    CASE WHEN {_crc_sql("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")} END AS other
  FROM documents
), p AS (
  SELECT *, leaf AS h, count(*) OVER (PARTITION BY tree) AS n,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d
), t AS ({_climb_sql(("p", "t"))}),
s AS (SELECT '' AS tree, tree AS source, h, count(*) OVER () AS n, row_number() OVER (ORDER BY tree) - 1 AS pos
  FROM t WHERE n = 1),
u AS ({_climb_sql(("s", "u"))}),
rt AS (SELECT tree, lvl, pos // 3 AS run, list(h ORDER BY pos) AS hs FROM t WHERE n > 1 GROUP BY ALL),
ru AS (SELECT lvl, pos // 3 AS run, list(h ORDER BY pos) AS hs FROM u WHERE n > 1 GROUP BY ALL),
f AS (
  SELECT tree, pos AS id, 0 AS lvl, pos, coalesce(other, leaf) AS h, '' AS proof FROM p UNION ALL
  SELECT f.tree, id, {_STEP_SQL} FROM f JOIN rt ON rt.tree = f.tree AND rt.lvl = f.lvl AND rt.run = f.pos // 3
), g AS (
  SELECT f.tree, id, 0 AS lvl, s.pos, f.h, proof FROM f JOIN s ON s.source = f.tree
  WHERE f.lvl = (SELECT max(lvl) FROM t WHERE t.tree = f.tree) UNION ALL
  SELECT f.tree, id, {_STEP_SQL} FROM g f JOIN ru ON ru.lvl = f.lvl AND ru.run = f.pos // 3
), e AS (SELECT * FROM g WHERE lvl = (SELECT max(lvl) FROM u)),
r AS (SELECT h AS root FROM u WHERE n = 1)
SELECT doc_id, leaf, s.h AS subroot, root, sha256(proof) AS proof_sha256, e.h AS folded_root, e.h = root AS verified
FROM p JOIN s ON s.source = p.tree JOIN e ON e.tree = p.tree AND e.id = p.pos CROSS JOIN r
"""


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.versions(_table(spark, sf_dir, "documents")).drop("copies")


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations")
    return repair.repaired(repair.damaged(rows), rows)


_BLANKS_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _cost_sql(letter: str, cost: str, rest: str) -> str:
    return f"{{c: CAST({cost} AS BIGINT) + {rest}.c, a: '{letter}' || {rest}.a}}"


def _state_sql(here: str, following: str, after: str) -> str:
    """The cheapest edits of a row in state ``here``: delete, keep or rerole to ``following``."""
    keep = f"WHEN i = '{following}' THEN {_cost_sql('K', 'extra', after)}"
    if here == "n":
        keep += f" WHEN i = 's' THEN {_cost_sql('K', 'extra', 's')}"
    return (f"least({_cost_sql('D', '2', here)}, CASE WHEN stays THEN {_cost_sql('R', '1 + extra', after)} END, "
            f"CASE WHEN NOT stays THEN NULL {keep} END)")


# backwards over the rows, the least (cost, audit) of each state: nothing, s, u or a written last
OP13_SQL = f"""
WITH RECURSIVE z AS (
  SELECT conv_id, turn, coalesce(CAST(conv_id AS VARCHAR), '-') AS conv, coalesce(role, ' ') AS role,
    coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':'
      || coalesce(CAST(turn AS VARCHAR), ' ') AS said FROM conversations
), k AS (SELECT *, {_crc_sql("said")} % 20 AS kind FROM z),
x AS (
  SELECT conv, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM k, range(2) t(copy) WHERE kind <> 0 AND (kind = 3 OR copy = 0)
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role,
    md5(conv || ':' || length(role) || ':' || role || ':' || text)) - 1 AS pos, left(role, 1) AS i,
    right(rtrim(text, {_BLANKS_SQL}), 1) AS last FROM x
), q AS (
  SELECT *, CASE WHEN last = '' THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY pos) > 1 THEN 'duplicate'
    WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    coalesce(lag(i) OVER (PARTITION BY conv ORDER BY pos) || i NOT IN ('su', 'ua', 'au'), false) AS bad FROM o
), m AS (SELECT *, fault NOT IN ('blank', 'duplicate') AS stays, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS extra
  FROM q),
w AS (
  SELECT conv, count(*) AS pos, {{c: 0::BIGINT, a: ''}} AS n, {{c: 10::BIGINT, a: 'II'}} AS s, {{c: 5::BIGINT, a: 'I'}} AS u,
    {{c: 0::BIGINT, a: ''}} AS a FROM m GROUP BY conv
  UNION ALL
  SELECT conv, pos, least(n, {_cost_sql('I', '5', 'least(u, ' + _cost_sql('I', '5', 'a') + ')')}),
    least(s, {_cost_sql('I', '5', 'least(u, ' + _cost_sql('I', '5', 'a') + ')')}), least(u, {_cost_sql('I', '5', 'a')}),
    least(a, {_cost_sql('I', '5', 'u')}) FROM (
      SELECT w.conv, m.pos, {_state_sql('n', 'u', 'u')} AS n, {_state_sql('s', 'u', 'u')} AS s,
        {_state_sql('u', 'a', 'a')} AS u, {_state_sql('a', 'u', 'u')} AS a
      FROM w JOIN m ON m.conv = w.conv AND m.pos = w.pos - 1)
), b AS (SELECT conv, n.c AS cost, n.a AS audit FROM w WHERE pos = 0),
l AS (SELECT conv, unnest(range(length(audit))) AS spot, unnest(string_split(audit, '')) AS letter FROM b WHERE audit <> ''),
e AS (
  SELECT conv, spot, letter, count(*) FILTER (letter <> 'I') OVER v - 1 AS pos, count(*) FILTER (letter <> 'D') OVER v - 1 AS k
  FROM l WINDOW v AS (PARTITION BY conv ORDER BY spot)
), j AS (
  SELECT e.*, role, text, max(letter = 'K' AND k = 0 AND i = 's') OVER (PARTITION BY e.conv) AS system
  FROM e LEFT JOIN m ON m.conv = e.conv AND m.pos = e.pos AND letter <> 'I' WHERE letter <> 'D'
), h AS (
  SELECT conv, sha256(string_agg(CASE WHEN letter = 'K' THEN role
      WHEN (k + CAST(system AS INT)) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10)
    ORDER BY spot)) AS sha FROM j GROUP BY conv
), c AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (bad) AS illegal FROM m GROUP BY conv
)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
  coalesce(audit, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, conv FROM z) LEFT JOIN c USING (conv) LEFT JOIN b USING (conv) LEFT JOIN h USING (conv)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_html_text, op2_warc, op3_merkle, op4_near_duplicates, op5_substring, op6_quality, op7_decontaminate, op8_url_filter,
                                  op9_mixing, op10_chat_format, op11_token_files, op12_manifest, op13_repair)}


def oracle_sql() -> dict[str, str]:
    return {"op2_warc": OP2_SQL, "op3_merkle": OP3_SQL, "op4_near_duplicates": OP4_SQL, "op5_substring": OP5_SQL, "op7_decontaminate": OP7_SQL, "op9_mixing": OP9_SQL,
            "op10_chat_format": OP10_SQL, "op12_manifest": OP12_SQL, "op13_repair": OP13_SQL}
