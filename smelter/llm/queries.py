"""One query per operator, each over its whole table, with SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.llm import bpe, chat, decontam, langid, line_dedup, ngram_join, pii, prefix_trie, quality, repair, topk, urls, warc
from smelter.llm.registry import ORACLES, QUERIES, query  # noqa: F401
from smelter.operators.lineage import cut_lineage
from smelter.sources.readers import table

_ESCAPED = "regexp_replace({}, '([<\\[])(\\\\*)(\\|(?:turn|text|end|image|audio|document)\\|>|/?s>|/?INST\\])', '\\1\\\\\\2\\3', 'g')"


@query(f"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
shown AS (
    SELECT *, '<|turn|>' || {_ESCAPED.format('role')} || '<|text|>' || {_ESCAPED.format('text')} || '<|end|>' AS shown
    FROM said
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, shown)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, shown) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(shown)) AS BIGINT) AS formatted_chars
FROM shown GROUP BY conv_id
""")
def op1_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    probe = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(probe).alias("text"))
    said = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    chats = chat.format_chats(said.select("conv_id", "turn", "role", chat.text_parts(F.col("text")).alias("parts")))
    turns = chats.select("conv_id", chat.read_turns(F.col("formatted")).alias("turns"),
                         F.length("formatted").cast("bigint").alias("formatted_chars"))
    read = turns.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
        .alias("all_text"), chat.loss_text(F.col("turns")).alias("loss_text"), "formatted_chars")
    return read.select("conv_id", "n_turns", F.sha2("all_text", 256).alias("turns_sha256"),
                       F.length("loss_text").cast("bigint").alias("loss_chars"),
                       F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")


URL_RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
             ("block", "com/de/"))


@query()
def op3_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf, "pages"), URL_RULES)


@query("""
WITH bodies AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
),
kept AS (
    SELECT payload_digest, max(page_id) AS kept FROM bodies WHERE payload_bytes >= 1000 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN kept > page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN kept > page_id THEN kept END AS refers_to
FROM bodies LEFT JOIN kept USING (payload_digest)
""")
def op9_warc(spark: SparkSession, sf: str) -> DataFrame:
    read = warc.round_trip(table(spark, sf, "pages"), with_payload=False)
    return read.select(F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("""
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS parts
    FROM embeddings WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
    SELECT q.vec_id AS query_id, v.vec_id, CAST(coalesce(list_sum(list_transform(
               range(1, least(len(q.parts), len(v.parts)) + 1), lambda i: q.parts[i] * v.parts[i])), 0) AS BIGINT) AS score
    FROM vectors q JOIN vectors v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM pairs QUALIFY rank <= 10
""")
def op10_topk(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings")
    return topk.top_k(vectors, vectors.filter(F.pmod("vec_id", F.lit(100)) == 0))


def held_out(modulus: int, left: int) -> Column:
    """Whether crc32 of the document's id as text leaves this remainder; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % modulus == left


@query()
def op6_langid(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    dictionaries = langid.fit_dictionaries(docs.filter(~held_out(4, 2)))
    return langid.identify(docs, dictionaries).select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")


@query()
def op7_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    odds = quality.fit(docs, table(spark, sf, "labels").filter(~held_out(5, 0)))
    scored = docs.select("doc_id", held_out(5, 0).alias("held_out"), quality.quality_of(F.col("text"), odds).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0))


@query()
def op8_pii(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = docs.select("doc_id", pii.personal_data(F.col("text"), with_masked=False).alias("found"))

    def count(kind: str) -> Column:
        return F.size(F.filter("found.base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, pii.BASE_KINDS),
                        F.sha2(pii.span_text(F.col("found.base")), 256).alias("base_sha256"),
                        pii.span_text(F.col("found.spans")).alias("spans"))


@query("""
WITH said AS (
    SELECT doc_id, regexp_extract_all(lower(text), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words FROM documents
),
items AS (
    SELECT item_id, key, words, least(len(words), 5) AS n
    FROM (SELECT item_id, row_number() OVER () AS key, regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words
          FROM (SELECT DISTINCT item_id, lower(text) AS text FROM benchmark))
    WHERE len(words) > 0
),
wanted AS (
    SELECT DISTINCT item_id, key, n, array_to_string(words[place:place + n - 1], ' ') AS shingle
    FROM (SELECT *, unnest(range(1, len(words) - n + 2)) AS place FROM items)
),
sizes AS (SELECT key, count(*) AS item_shingles FROM wanted GROUP BY key),
shown AS (
    SELECT DISTINCT doc_id, n, array_to_string(words[place:place + n - 1], ' ') AS shingle
    FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS place FROM said, (SELECT DISTINCT n FROM items))
),
met AS (SELECT doc_id, item_id, key, count(*) AS shared FROM shown JOIN wanted USING (n, shingle) GROUP BY ALL)
SELECT doc_id, item_id, max(shared) AS shared, max(item_shingles) AS item_shingles
FROM met JOIN sizes USING (key) WHERE shared * 100 >= item_shingles * 80 GROUP BY doc_id, item_id
""")
def op2_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontam.find_contained(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
),
placed AS (
    SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 1) + 1)) AS place FROM worded WHERE len(words) > 0
),
shingles AS (SELECT DISTINCT doc_id, array_to_string(words[place:place + 2], ' ') AS shingle FROM placed),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
met AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
    SELECT a, b FROM met JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * shared >= 90 * (x.n + y.n - shared)
),
reached AS (
    SELECT a AS doc_id, a AS other FROM links
    UNION
    SELECT reached.doc_id, links.b FROM reached JOIN links ON links.a = reached.other
),
smallest AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN smallest USING (doc_id)
""")
def op5_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.jaccard_groups(table(spark, sf, "documents"))


RANKS = "byte_bpe_multi_50k.tiktoken"


@query()
def op4_bpe(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path(RANKS)
    encoded = bpe.encode(table(spark, sf, "documents"), path, public_tokenizers.PATTERN, decoded=True)
    return encoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query("""
WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
placed AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM cut),
keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM placed
),
shared AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
),
judged AS (SELECT keyed.*, coalesce(keeper <> doc_id, false) AS dropped FROM keyed LEFT JOIN shared USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
""")
def op12_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


#: Unsigned CRC-32 of an ASCII string, bit by bit.
_CRC32 = ("xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({}, ''), lambda c: CAST(ascii(c) AS BIGINT))), "
          "lambda crc, code: list_reduce(list_prepend(xor(crc, code), range(8)), lambda x, i: "
          "CASE WHEN x % 2 = 1 THEN xor(x // 2, CAST(3988292384 AS BIGINT)) ELSE x // 2 END)))")


@query(f"""
WITH own AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS said,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(said)) AS place
    FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (SELECT conv_id, {_CRC32.format('CAST(conv_id AS VARCHAR)')} % 9 AS h FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)),
taken AS (
    SELECT convs.conv_id, 0 AS part, place, said, text FROM convs JOIN own ON own.conv_id = convs.conv_id - convs.conv_id % 5 WHERE place <= h
    UNION ALL
    SELECT conv_id, 1, place, said, text FROM convs JOIN own USING (conv_id) WHERE place > h
),
turns AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, place) AS depth, sha256(said) AS said, strlen(text) AS bytes FROM taken),
paths AS (
    SELECT conv_id, depth, bytes, string_agg(said, '') OVER (PARTITION BY conv_id ORDER BY depth) AS key FROM turns
    UNION ALL SELECT conv_id, 0, 0, '' FROM convs
),
linked AS (SELECT *, lag(key) OVER (PARTITION BY conv_id ORDER BY depth) AS parent, max(depth) OVER (PARTITION BY conv_id) AS last FROM paths),
nodes AS (
    SELECT key, any_value(parent) AS parent, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs, any_value(bytes) AS bytes,
           sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (depth = last), '')) AS ends_sha256
    FROM linked GROUP BY key
),
born AS (SELECT parent AS key, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
below AS (SELECT DISTINCT a.key AS top, b.key AS key FROM paths a JOIN paths b ON a.conv_id = b.conv_id AND a.depth <= b.depth),
sums AS (
    SELECT top AS key, count(*) FILTER (n_children IS NULL) AS n_leaves, CAST(sum((n_convs - 1) * bytes) AS BIGINT) AS saved_tokens
    FROM below JOIN nodes USING (key) LEFT JOIN born USING (key) GROUP BY top
)
SELECT nodes.conv_id, nodes.depth, above.conv_id AS parent_conv_id, nodes.n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves, saved_tokens, nodes.ends_sha256
FROM nodes JOIN sums USING (key) LEFT JOIN born USING (key) LEFT JOIN nodes above ON above.key = nodes.parent
""")
def op13_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    lists = prefix_trie.turn_lists(table(spark, sf, "conversations"))
    conv, take = F.col("conv_id"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    return prefix_trie.prefix_trie(prefix_trie.with_start_of(lists, conv - conv % 5, take, most=8))


def _sql_edit(letter: str, cost: str, then: str, line: str | None = None) -> str:
    lines = f"[{line}] || {then}.lines" if line else f"{then}.lines"
    return f"{{'cost': {cost} + {then}.cost, 'audit': '{letter}' || {then}.audit, 'lines': {lines}}}"


def _sql_least(*options: str) -> str:
    return f"list_sort([{', '.join(options)}])[1]"


def _sql_taken(state: str, kept: dict[str, str], made: str, role: str) -> str:
    """The best of deleting, keeping and reroling one turn, before insertions."""
    best = _sql_least(_sql_edit("D", "3", state), _sql_edit("R", "2 + cut", made, f"'{role}:' || text"))
    for initial, then in kept.items():
        keep = _sql_edit("K", "cut", then, "role || ':' || text")
        best = f"CASE WHEN initial = '{initial}' THEN {_sql_least(best, keep)} ELSE {best} END"
    return f"CASE WHEN must_go THEN {_sql_edit('D', '3', state)} ELSE {best} END"


_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@query(f"""
WITH RECURSIVE source AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           sha256(length(coalesce(role, ' ')) || ':' || coalesce(role, ' ') || coalesce(text, ' ')) AS tie,
           {_CRC32.format("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS harm
    FROM conversations
),
harmed AS (
    SELECT conv_id, turn, tie, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN harm = 1 THEN '' WHEN harm = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(range(CASE WHEN harm = 0 THEN 0 WHEN harm = 3 THEN 2 ELSE 1 END)) AS copy
    FROM source
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, tie, copy) AS place, left(role, 1) AS initial,
           rtrim(text, {_BLANKS}) AS bare FROM harmed
),
judged AS (
    SELECT *, bare = '' AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 AS seen,
           CAST(right(bare, 1) NOT IN ('.', '!', '?') AS INTEGER) AS cut, blank OR seen AS must_go,
           lag(initial) OVER (PARTITION BY conv_id ORDER BY place) || initial AS pair
    FROM placed
),
faults AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
           count(*) FILTER (seen AND NOT blank) AS duplicate, count(*) FILTER (cut = 1 AND NOT must_go) AS truncated,
           count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS places
    FROM judged GROUP BY conv_id
),
steps AS (
    SELECT conv_id, places + 1 AS place, {{'cost': 0, 'audit': '', 'lines': CAST([] AS VARCHAR[])}} AS f0,
           {{'cost': 4, 'audit': 'II', 'lines': ['user:', 'assistant:']}} AS f1, {{'cost': 2, 'audit': 'I', 'lines': ['assistant:']}} AS f2,
           {{'cost': 0, 'audit': '', 'lines': CAST([] AS VARCHAR[])}} AS f3
    FROM faults
    UNION ALL
    SELECT conv_id, place, {_sql_least('g0', _sql_edit('I', '2', 'h2', "'user:'"))}, {_sql_least('g1', _sql_edit('I', '2', 'h2', "'user:'"))}, h2, h3
    FROM (
        SELECT conv_id, place, g0, g1, {_sql_least('g2', _sql_edit('I', '2', 'g3', "'assistant:'"))} AS h2,
               {_sql_least('g3', _sql_edit('I', '2', 'g2', "'user:'"))} AS h3
        FROM (
            SELECT judged.conv_id, judged.place, {_sql_taken('f0', {'s': 'f1', 'u': 'f2'}, 'f2', 'user')} AS g0,
                   {_sql_taken('f1', {'u': 'f2'}, 'f2', 'user')} AS g1, {_sql_taken('f2', {'a': 'f3'}, 'f3', 'assistant')} AS g2,
                   {_sql_taken('f3', {'u': 'f2'}, 'f2', 'user')} AS g3
            FROM steps JOIN judged ON judged.conv_id IS NOT DISTINCT FROM steps.conv_id AND judged.place = steps.place - 1
        )
    )
),
originals AS (SELECT DISTINCT conv_id FROM conversations)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(f0.cost, 0) AS BIGINT) AS cost,
       coalesce(f0.audit, '') AS audit, sha256(coalesce(array_to_string(f0.lines, chr(10)), '')) AS repaired_sha256
FROM originals o LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN steps s ON s.conv_id IS NOT DISTINCT FROM o.conv_id AND s.place = 1
""")
def op11_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    said = table(spark, sf, "conversations")
    turns = repair.ordered_turns(said)
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    harm = F.crc32(key.cast("binary")) % 20
    copies = F.when(harm == 0, F.array().cast("array<int>")).when(harm == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    harmed = turns.withColumn("harm", harm).withColumn("copy", F.explode(copies)).select(
        "conv_id", "turn", "tie", F.when(F.col("harm") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"))
    plans = cut_lineage(repair.repair_plans(harmed))
    digests = repair.repaired_digests(harmed, plans).withColumnRenamed("conv_id", "_digest_of")
    originals = said.select("conv_id").distinct()
    known = plans.withColumnRenamed("conv_id", "_plan_of")
    found = originals.join(known, F.col("conv_id").eqNullSafe(F.col("_plan_of")), "left").join(
        digests, F.col("conv_id").eqNullSafe(F.col("_digest_of")), "left")
    counts = (F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))
    return found.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
