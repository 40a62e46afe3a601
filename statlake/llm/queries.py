"""One query for each operator over its whole table, and SQL where it can express the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statlake.llm.common import read
from statlake.llm.decontaminate import LEAST, WINDOW, contaminated
from statlake.llm.html_extract import extract_main_text
from statlake.llm.kd_shards import kd_shards
from statlake.llm.language_id import fit_languages, identify_languages
from statlake.llm.mixing import mix_decisions
from statlake.llm.near_dedup import near_duplicates
from statlake.llm.ngram_filter import score_texts
from statlake.llm.preferences import END, HEAD_CLOSE, HEAD_OPEN, LEARNT, format_preferences, mask, pair_neighbours
from statlake.llm.prefix_trie import ordered_turns, prefix_trie, with_shared_heads
from statlake.llm.token_links import token_links
from statlake.llm.token_records import token_records
from statlake.llm.toxicity import fit_toxicity, score_toxicity
from statlake.llm.weighted_sampling import weighted_fingerprints

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


@query
def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), k=2, percent=80)


@query
def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(read(spark, sf_dir, "pages"))


@query
def op3_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_records(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mix_decisions(read(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"))


@query
def op5_bigram_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_texts(read(spark, sf_dir, "documents"), fold("doc_id", 5) != 1)
    return scored.withColumn("held_out", ~F.col("train")).drop("train")


@query
def op6_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards(read(spark, sf_dir, "documents"), shards=40)


@query
def op7_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_fingerprints(read(spark, sf_dir, "documents"))


@query
def op8_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = format_preferences(pair_neighbours(read(spark, sf_dir, "conversations")))
    return pairs.select(
        "pair_id",
        "chosen_id",
        "rejected_id",
        "n_common",
        "prompt",
        "chosen",
        "rejected",
        mask(F.col("chosen_segments")).alias("chosen_mask"),
        mask(F.col("rejected_segments")).alias("rejected_mask"),
    )


def fold(doc_id: str, folds: int) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "labels").filter(fold("doc_id", 5) != 0)


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = fit_toxicity(docs, training_labels(spark, sf_dir))
    return score_toxicity(docs, model).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "passages"
    )


@query
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "contaminated", "n_items", "first_item_id")


# every alignment of a document with an item, word by word, without seeds
ORACLE["op10_decontaminate"] = rf"""
WITH split AS (
    SELECT coalesce(CAST(doc_id AS VARCHAR), 'null ' || md5(coalesce(text, ''))) AS doc,
        regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS ws
    FROM documents
), items AS (
    SELECT min(item_id) AS item_id, ws FROM (
        SELECT item_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS ws
        FROM benchmark WHERE text IS NOT NULL
    ) GROUP BY ws HAVING len(ws) > 0
), d AS (SELECT doc, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM split),
i AS (SELECT item_id, len(ws) AS n, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM items),
same AS (
    SELECT doc, item_id, n, d.pos - i.pos AS line, d.pos AS pos,
        count(*) OVER (
            PARTITION BY doc, item_id, d.pos - i.pos ORDER BY d.pos
            RANGE BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING
        ) AS agree
    FROM d JOIN i USING (w)
), found AS (
    SELECT doc, count(DISTINCT item_id) AS n_items, min(item_id) AS first_item_id
    FROM same WHERE agree >= CASE WHEN n < {WINDOW} THEN n ELSE {LEAST} END GROUP BY doc
)
SELECT doc_id, n_items IS NOT NULL AS contaminated, CAST(coalesce(n_items, 0) AS INTEGER) AS n_items, first_item_id
FROM documents LEFT JOIN found ON found.doc = coalesce(CAST(doc_id AS VARCHAR), 'null ' || md5(coalesce(text, '')))
"""

# the same sample by one sort of each source instead of histograms
ORACLE["op4_source_mix"] = r"""
WITH docs AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
        (('0x' || left(md5(concat(coalesce(CAST(doc_id AS VARCHAR), ''), '|7')), 13))::BIGINT + 0.5::DOUBLE)
            / 4503599627370496.0::DOUBLE AS u
    FROM documents
), leveled AS (SELECT *, length(CAST(size AS VARCHAR)) AS level FROM docs),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM leveled GROUP BY source),
s1 AS (
    SELECT *, (3 * source_size)::DOUBLE AS cap, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w,
        sum(source_size) OVER () AS every
    FROM s0
), s2 AS (
    SELECT *, (every - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate FROM s1
), s AS (SELECT source, source_size, least(cap, max(rate) OVER () * w) AS target FROM s2),
c0 AS (SELECT source, level, CAST(sum(size) AS BIGINT) AS words FROM leveled GROUP BY source, level),
c1 AS (
    SELECT c0.*, source_size, target, (3 * words)::DOUBLE AS cap, greatest(level * words, 1e-9)::DOUBLE AS w
    FROM c0 JOIN s ON c0.source IS NOT DISTINCT FROM s.source
), c2 AS (
    SELECT *, (target - coalesce(sum(cap) OVER (PARTITION BY source ORDER BY cap / w, level ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(w) OVER (PARTITION BY source ORDER BY cap / w, level ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate FROM c1
), c3 AS (SELECT *, least(cap, max(rate) OVER (PARTITION BY source) * w) AS allotted FROM c2),
c4 AS (SELECT *, CASE WHEN words > 0 THEN allotted / words ELSE 0 END AS mean FROM c3),
c AS (
    SELECT *, floor(mean) AS sure, mean - floor(mean) AS chance,
        target - sum(floor(mean) * words) OVER (PARTITION BY source) AS rest FROM c4
), q AS (
    SELECT l.doc_id, l.size, c.source, source_size, target, sure, rest,
        CASE WHEN chance > 0 THEN (u / (1 - u)) / (chance / (1 - chance)) END AS q
    FROM leveled l JOIN c ON l.source IS NOT DISTINCT FROM c.source AND l.level = c.level
), p AS (SELECT *, q / (1 + q) AS p FROM q),
o AS (
    SELECT *, sum(CASE WHEN p IS NULL THEN 0 ELSE size END) OVER (PARTITION BY source ORDER BY p NULLS LAST, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) AS so_far FROM p
)
SELECT doc_id, size, source_size, target,
    CAST((sure + CASE WHEN p IS NOT NULL AND 2 * so_far - size <= 2 * rest THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM o
"""


_OPEN, _CLOSE, _END = ("'" + x.replace("\n", "' || chr(10) || '") + "'" for x in (HEAD_OPEN, HEAD_CLOSE, END))
# turn by turn instead of by arrays
ORACLE["op8_preferences"] = rf"""
WITH t AS (
    SELECT conv_id // 2 AS pair_id, conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), words AS (
    SELECT pair_id, conv_id,
        sum(CASE WHEN role = '{LEARNT}' THEN len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) ELSE 0 END) AS n
    FROM t GROUP BY ALL
), best AS (
    SELECT pair_id, first(conv_id ORDER BY n DESC, conv_id) AS chosen_id,
        CASE WHEN count(*) > 1 THEN last(conv_id ORDER BY n DESC, conv_id) END AS rejected_id
    FROM words GROUP BY pair_id
), side AS (SELECT t.*, conv_id = chosen_id AS chosen FROM t JOIN best USING (pair_id)),
shorter AS (
    SELECT pair_id, least(count(*) FILTER (chosen), count(*) FILTER (NOT chosen)) AS n FROM side GROUP BY pair_id
), differ AS (
    SELECT c.pair_id, min(c.pos) AS pos FROM side c JOIN side r ON c.pair_id = r.pair_id AND c.pos = r.pos AND c.chosen AND NOT r.chosen
    WHERE c.role <> r.role OR c.text <> r.text GROUP BY c.pair_id
), common AS (SELECT pair_id, coalesce(differ.pos - 1, n) AS n FROM shorter LEFT JOIN differ USING (pair_id)),
r AS (
    SELECT side.*, pos <= n AS shared, {_OPEN} || role || {_CLOSE} AS head, text || {_END} AS body FROM side JOIN common USING (pair_id)
)
SELECT pair_id, chosen_id, rejected_id, CAST(n AS INTEGER) AS n_common,
    coalesce(string_agg(head || body, '' ORDER BY pos) FILTER (shared AND chosen), '') AS prompt,
    coalesce(string_agg(head || body, '' ORDER BY pos) FILTER (NOT shared AND chosen), '') AS chosen,
    coalesce(string_agg(head || body, '' ORDER BY pos) FILTER (NOT shared AND NOT chosen), '') AS rejected,
    coalesce(string_agg(concat(length(head), '- ', length(body), CASE WHEN role = '{LEARNT}' THEN '+' ELSE '-' END), ' ' ORDER BY pos) FILTER (NOT shared AND chosen), '') AS chosen_mask,
    coalesce(string_agg(concat(length(head), '- ', length(body), CASE WHEN role = '{LEARNT}' THEN '+' ELSE '-' END), ' ' ORDER BY pos) FILTER (NOT shared AND NOT chosen), '') AS rejected_mask
FROM r JOIN best USING (pair_id) JOIN common USING (pair_id) GROUP BY pair_id, chosen_id, rejected_id, n
"""


@query
def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = fit_languages(docs.filter(fold("doc_id", 4) != 2))
    held_out = (fold("doc_id", 4) == 2).alias("held_out")
    return identify_languages(docs, model).select("doc_id", held_out, "lang_pred", "score")


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(with_shared_heads(ordered_turns(read(spark, sf_dir, "conversations"))))


# every prefix of every conversation as a list, grouped; sums over subtrees by all prefixes of each node
ORACLE["op12_prefix_trie"] = r"""
WITH own AS (
    SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''),
        md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), bytes AS (  -- crc32, bit by bit: -1 stands for a shift
    SELECT conv_id, turns, conv_id - conv_id % 100 AS head,
        flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])) AS steps FROM own
), h AS (
    SELECT conv_id, turns, head, xor(list_reduce(list_concat([4294967295::BIGINT], steps), lambda a, x:
        CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384::BIGINT * (a & 1)) END), 4294967295::BIGINT) % 6 AS h FROM bytes
), rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(g.turns[:c.h], []), c.turns[c.h + 1:]) AS turns FROM h c LEFT JOIN own g ON g.conv_id = c.head
), member AS (
    SELECT conv_id, depth, turns[:depth] AS prefix, len(turns) = depth AS last FROM (SELECT *, unnest(range(len(turns) + 1)) AS depth FROM rebuilt)
), node AS (
    SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
    FROM member GROUP BY prefix, depth
), child AS (
    SELECT prefix[:depth - 1] AS prefix, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1
), own_sums AS (
    SELECT node.*, coalesce(child.n, 0) AS n_children, CASE WHEN child.n IS NULL THEN 1 ELSE 0 END AS leaf,
        CASE WHEN depth > 0 THEN (n_convs - 1) * length(node.prefix[-1].text) ELSE 0 END AS saved
    FROM node LEFT JOIN child ON child.prefix = node.prefix
), subtree AS (
    SELECT prefix[:up] AS prefix, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens
    FROM (SELECT *, unnest(range(depth + 1)) AS up FROM own_sums) GROUP BY 1
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, CAST(n.n_children AS BIGINT) AS n_children,
    CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM own_sums n JOIN subtree s ON s.prefix = n.prefix LEFT JOIN node p ON n.depth > 0 AND p.prefix = n.prefix[:n.depth - 1]
"""


@query
def op13_token_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return token_links(read(spark, sf_dir, "documents"), *paths)
