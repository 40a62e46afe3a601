"""The pipeline's stages on planted cases, and the registered queries on the smallest tables."""

import collections
import random

import duckdb
import pytest
from conftest import SF_DIR
from llm.conftest import KIND
from llm.test_native import prose
from llm.test_near_dedup import groups
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import corpus_pipeline
from statlake.llm.queries import ORACLE, QUERIES

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Documents with copies, near copies, toxic texts and leaks, beside clean ones and odd rows."""
    rng = random.Random(9)
    folder = str(tmp_path_factory.mktemp("tables"))
    item = prose(rng, 30)
    texts, labels = {}, []
    for i in range(0, 1200, 2):
        text = prose(rng, rng.randint(20, 120)).split()
        if i % 12 == 0:
            for _ in range(6):
                text.insert(rng.randrange(len(text)), rng.choice(["vile", "nasty", "awful"]))
        labels.append((i, 1, int(i % 12 == 0)))
        texts[i] = " ".join(text)
    for i in range(2, 200, 8):
        texts[i + 1] = texts[i]  # exact copies
        near = texts[i].split()
        near[len(near) // 2] = "other"
        texts[i + 3] = " ".join(near) if len(near) > 70 else texts[i]
    leaks = [302, 304, 310, 314]
    for i in leaks:
        texts[i] = f"{texts[i]} {item} {prose(rng, 5)}"
    rows = [(i, t, "en", f"s{i % 5}" if i % 7 else None, len(t)) for i, t in texts.items()]
    rows += [(9001, None, "en", "s1", 0), (9002, "", "en", "s1", 0), (9003, "tiny", "en", "s2", 4), (9003, "tiny", "en", "s2", 4)]
    spark.createDataFrame(rows, KIND).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(7, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, leaks


def test_each_stage_on_its_own_input(spark, tables):
    folder, rows, leaks = tables
    docs = spark.createDataFrame(rows, KIND)
    step = {name: stage for name, stage in corpus_pipeline.STAGES}
    assert list(step) == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"]
    ids = lambda df: sorted(r["doc_id"] for r in df.collect())
    toxic = {r[0] for r in rows if r[1] and {"vile", "nasty", "awful"} & set(r[1].split())}

    kept = step["toxicity"](spark, docs, folder)
    assert kept.columns == COLUMNS
    assert ids(kept) == sorted(r[0] for r in rows if r[0] not in toxic)

    kept = step["near_dedup"](spark, docs, folder)
    assert kept.columns == COLUMNS
    smallest = groups([r[:2] for r in rows], k=5)
    assert ids(kept) == sorted({d for d, c in smallest.items() if d == c})

    kept = step["decontamination"](spark, docs, folder)
    assert kept.columns == COLUMNS
    assert ids(kept) == sorted(r[0] for r in rows if r[0] not in leaks)

    mixed = step["mixing"](spark, docs, folder)
    assert mixed.columns == COLUMNS
    times = collections.Counter(r["doc_id"] for r in mixed.collect())
    assert max(times.values()) <= 6 and times.keys() <= {r[0] for r in rows}  # 9003 is there twice

    placed = step["sharding"](spark, mixed, folder)
    assert collections.Counter(r["doc_id"] for r in placed.collect()) == times


def test_leaks_go_by_their_rows(spark, tables):
    """A leak with a null id goes; a clean text stays though its id is null or has a leak."""
    folder, rows, leaks = tables
    text = next(r[1] for r in rows if r[0] == leaks[0])
    made = [(None, text), (None, "clean words"), (None, None), (5, text), (5, "other clean words"), (6, "clean words")]
    docs = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in made], KIND)
    kept = dict(corpus_pipeline.STAGES)["decontamination"](spark, docs, folder).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=repr) == sorted((x for x in made if x[1] != text), key=repr)


def test_repeated_and_null_ids_are_told_apart_by_their_texts(spark, tables):
    rng = random.Random(12)
    a, b, c, d = (prose(rng, 60) for _ in range(4))
    made = [(1, a), (1, b), (1, b), (2, b), (3, c), (None, c), (None, d), (None, d), (None, None), (4, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in made], KIND)
    kept = dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, tables[0]).collect()
    first, other = min(a, b), max(a, b)
    # the smallest text keeps id 1; b is also 2's, and null ids stay only with texts of their own
    wanted = [(1, first), (3, c), (None, d), (None, None), (4, None)]
    wanted.append((1, a) if other == a else (2, b))
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=repr) == sorted(wanted, key=repr)


def test_run_applies_the_stages(spark, tables):
    folder, rows, leaks = tables
    found = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "shard", "slot"} <= set(found.columns)
    ids = {r["doc_id"] for r in found.collect()}
    assert ids and not ids & set(leaks)
    smallest = groups([r[:2] for r in rows], k=5)
    assert all(smallest[d] == d or smallest[d] % 12 == 0 for d in ids)


def test_stages_of_an_empty_table(spark, tables):
    docs = spark.createDataFrame([], KIND)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, tables[0]).collect() == [], name


def test_all_are_registered():
    names = set(entry_point.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in QUERIES) == 1
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    result = duck.execute(ORACLE[name])
    columns = sorted(c[0] for c in result.description)
    wanted = [tuple(r[c] for c in columns) for r in result.df().astype(object).where(lambda x: x.notna(), None).to_dict("records")]
    made = QUERIES[name](spark, SF_DIR)
    assert sorted(made.columns) == columns
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in made.collect()))) == sorted(map(repr, wanted))


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("op1_near_dedup", "doc_id n_shingles component_id kept"),
        ("op2_main_text", "page_id url text n_chars"),
        ("op3_token_records", "doc_id start n_tokens ids_crc32"),
        ("op5_bigram_scores", "doc_id held_out n_tokens n_known train_tokens base_score score"),
        ("op6_kd_shards", "doc_id size text_crc32 law shard slot grown_shard"),
        ("op7_weighted_fingerprints", "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next"),
        ("op9_toxicity", "doc_id held_out score predicted"),
    ],
)
def test_query_has_a_row_for_each_row(spark, name, columns):
    made = QUERIES[name](spark, SF_DIR)
    assert set(columns.split()) <= set(made.columns)
    table, key = ("pages", "page_id") if "page_id" in columns else ("documents", "doc_id")
    whole = spark.read.parquet(f"{SF_DIR}/{table}.parquet")
    assert made.select(key).exceptAll(whole.select(key)).isEmpty()
    assert made.agg(F.count("*")).first()[0] == whole.count()
