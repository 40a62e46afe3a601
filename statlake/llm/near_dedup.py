"""Near-duplicate groups by fast similarity sketching, banding and exact verification."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.llm.common import hand_back, hashed_words, let_go, materialize, mix, narrowed, seeds, ship, slices
from statlake.llm.components import components, contract, labels

#: Bands and rows: a pair at similarity 0.8 shares no band with probability 6e-6.
BANDS, ROWS = 40, 6
BINS = BANDS * ROWS
#: An estimate from BINS coordinates has a deviation of 0.026 at 0.8; pairs below this are not verified.
LEAST_ESTIMATE = 0.68
#: Documents that are compared with one another by one Python call, and with one hub.
BLOCK, STAR = 512, 256
#: So many shingles of a document count as one more document there.
LONG = 20_000

_LOW = np.uint64((1 << 48) - 1)
_SEEDS = seeds(2 * BINS, 11)
_FIRST = 2048


def shingle_sets(text: pa.Array, k: int) -> Iterator[np.ndarray]:
    """For each row the sorted distinct hashes of its k-word shingles.

    A text with fewer words has its whole sequence as one shingle; one without words has none.
    """
    words, offsets = hashed_words(text)
    multipliers = seeds(k, 5) | np.uint64(1)
    for start, end in zip(offsets[:-1], offsets[1:], strict=True):
        own = words[start:end]
        if not len(own):
            yield own
            continue
        wide = min(k, len(own))
        sums = np.full(len(own) - wide + 1, wide, np.uint64)
        for j in range(wide):
            sums += own[j : len(own) - wide + 1 + j] * multipliers[j]
        yield np.unique(mix(sums))


def sketch(elements: np.ndarray) -> np.ndarray:
    """One coordinate for each bin: the smallest (round, value) that any element puts there.

    In round i each element goes to one hashed bin with value i plus a fraction. Bins still empty
    after BINS rounds are filled by a round of their own, so every coordinate has a value and two
    sketches agree in each coordinate with the Jaccard probability, with concentration.
    """
    bins = np.full(BINS, np.iinfo(np.uint64).max, np.uint64)
    done = 0
    while done < BINS and (bins == np.iinfo(np.uint64).max).any():
        rounds = np.arange(done, min(BINS, done + max(1, _FIRST // len(elements))))
        h = mix(elements[None, :] ^ _SEEDS[rounds][:, None])
        place = ((h >> np.uint64(48)) * np.uint64(BINS)) >> np.uint64(16)
        key = (h & _LOW) | (rounds.astype(np.uint64) << np.uint64(48))[:, None]
        np.minimum.at(bins, place.ravel().astype(np.int64), key.ravel())
        done += len(rounds)
    for j in np.flatnonzero(bins == np.iinfo(np.uint64).max):
        bins[j] = (mix(elements ^ _SEEDS[BINS + j]) & _LOW).min() | np.uint64((BINS + j) << 48)
    return bins


def _sketches(batches: Iterable[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        sizes, low, high, signs = [], [], [], []
        for own in shingle_sets(batch.column("text"), k):
            sizes.append(len(own))
            if not len(own):
                low.append(0), high.append(0), signs.append(b"")
                continue
            low.append(int(own.sum(dtype=np.uint64).view(np.int64)))
            high.append(int(mix(own).sum(dtype=np.uint64).view(np.int64)))
            signs.append(mix(sketch(own)).astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").cast(pa.int64()),
                pa.array(sizes, pa.int64()),
                pa.array(low, pa.int64()),
                pa.array(high, pa.int64()),
                pa.array(signs, pa.binary()),
            ],
            names=["doc_id", "n_shingles", "low", "high", "sign"],
        )
    hand_back()


def _likely(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, y = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, BINS)
            for c in ("sign_a", "sign_b")
        )
        yield batch.filter(pa.array((x == y).mean(axis=1) >= LEAST_ESTIMATE)).select(["a", "b"])


def _sets(texts: pd.Series, k: int) -> list[np.ndarray]:
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], names=["text"])
    return [own for part in slices([batch], "text") for own in shingle_sets(part.column("text"), k)]


def _alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _verified(star: pd.DataFrame, k: int, percent: int) -> pd.DataFrame:
    """The links of a hub, on full sets, among some of the documents that are compared with it."""
    hub = int(star["hub"].iloc[0])
    star = star.drop_duplicates(["doc", "text"])
    docs, sets = star["doc"].to_numpy(), _sets(star["text"], k)
    hand_back(1.0)
    own = [s for d, s in zip(docs, sets, strict=True) if d == hub]
    out = {d for d, s in zip(docs, sets, strict=True) if d != hub and any(_alike(s, x, percent) for x in own)}
    return pd.DataFrame({"a": sorted(out), "b": hub}, dtype="int64")


class _Union:
    """Groups of the component ids seen in one block."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        while (above := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(above, above)
            x = above
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)
        return x != y


def _signs(rows: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(rows["sign"]), np.uint8).reshape(len(rows), BINS)


def _kin(bucket: pd.DataFrame) -> pd.DataFrame:
    """Of two blocks of a bucket, links that span the components whose sketches come close."""
    first, second = int(bucket["i"].iloc[0]), int(bucket["j"].iloc[0])
    signs, comps, block = _signs(bucket), bucket["comp"].to_numpy(), bucket["block"].to_numpy()
    names, counts = np.unique(comps, return_counts=True)
    most = names[counts.argmax()]
    seen, out = _Union(), []
    for x in np.flatnonzero(comps != most):
        other = np.flatnonzero((comps != comps[x]) & (block == (second if block[x] == first else first)))
        near = other[(signs[other] == signs[x]).mean(axis=1) >= LEAST_ESTIMATE]
        out += [(max(comps[x], y), min(comps[x], y)) for y in np.unique(comps[near]) if seen.join(comps[x], y)]
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def _cross(rows: pd.DataFrame, k: int, percent: int) -> pd.DataFrame:
    """Verified links from a block of queries to a block of their cluster, enough to join components."""
    signs, comps, docs = _signs(rows), rows["comp"].to_numpy(), rows["doc"].to_numpy()
    sets = _sets(rows["text"], k)
    hand_back(1.0)
    asks = rows["ask"].to_numpy()
    data = np.flatnonzero(~asks)
    seen, out = _Union(), []
    for x in np.flatnonzero(asks):
        close = (signs[data] == signs[x]).mean(axis=1)
        for y in data[np.argsort(-close, kind="stable")][: int((close >= LEAST_ESTIMATE).sum())]:
            if seen.find(comps[x]) == seen.find(comps[y]):
                continue
            if _alike(sets[x], sets[y], percent):
                seen.join(comps[x], comps[y])
                out.append((max(docs[x], docs[y]), min(docs[x], docs[y])))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def _close(pairs: DataFrame, signs: DataFrame) -> DataFrame:
    """Pairs whose sketches are close enough to be worth the exact check."""
    side = lambda c: signs.select(F.col("doc").alias(c), F.col("sign").alias(f"sign_{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_likely, "a long, b long")


def _weight() -> Column:
    """What a document counts where texts meet: long ones count more, so that bytes are bounded too."""
    return F.lit(1) + F.floor(F.col("n_shingles") / LONG)


def _confirm(pairs: DataFrame, kept: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links among pairs (a, b): b's text meets the texts of about STAR of its partners at once, of fewer if they are long."""
    sizes = pairs.join(kept.select(F.col("doc").alias("a"), _weight().alias("weight")), "a")
    hubs = sizes.groupBy(F.col("b").alias("hub")).agg(F.ceil(F.sum("weight") / STAR).cast("long").alias("parts"))
    wanted = pairs.withColumnRenamed("b", "hub").join(hubs, "hub")
    wanted = wanted.select("hub", F.col("a").alias("doc"), F.pmod(F.xxhash64("a"), F.col("parts")).alias("part"))
    own = hubs.select("hub", F.col("hub").alias("doc"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    asked = materialize(pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct())
    rows = wanted.unionByName(own).join(narrowed(texts.select(F.col("doc_id").alias("doc"), "text"), asked, "doc"), "doc")
    return rows.groupBy("hub", "part").applyInPandas(lambda star: _verified(star, k, percent), "a long, b long")


def _across(kept: DataFrame, crowded: DataFrame, first: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links between the components that the stars left apart in a common bucket.

    Buckets that hold several components are compared by sketches, in blocks, which gives clusters of
    components that may link. In each cluster, all members outside its largest component are queries:
    blocks of them meet blocks of the whole cluster and are checked on full sets until their
    components are one. What comes out is linear in the members.
    """
    own = materialize(kept.join(first.withColumnRenamed("node", "doc"), "doc", "left").select("doc", "n_shingles", "sign", F.coalesce("component", "doc").alias("comp")))
    # two sums of hashes tell sets of members apart: a set that many bands put together is compared once
    hashed = lambda seed: F.sum(F.xxhash64(F.lit(seed), "doc").cast("decimal(20,0)")).alias(f"h{seed}")
    mixed = (
        crowded.select("key", "doc").join(own.select("doc", "comp"), "doc").groupBy("key")
        .agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("n"), hashed(1), hashed(2))
        .filter("lo < hi and n > 2")
        .groupBy("n", "h1", "h2")
        .agg(F.min("key").alias("key"))
        .select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("parts"))
    )
    # ids first: only what is compared meets its sketch
    placed = (
        crowded.select("key", "doc").join(mixed, "key")
        .withColumn("block", F.pmod(F.xxhash64("doc"), F.col("parts").cast("long")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("key", "doc", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
        .join(own, "doc")
        .select("key", "comp", "sign", "block", "i", "j")
    )
    clusters = materialize(components(placed.groupBy("key", "i", "j").applyInPandas(_kin, "a long, b long")))
    let_go(crowded)
    members = own.join(clusters.select(F.col("node").alias("comp"), F.col("component").alias("cluster")), "comp")
    sizes = members.groupBy("cluster", "comp").agg(F.sum(_weight()).alias("n"))
    sizes = sizes.groupBy("cluster").agg(F.sum("n").alias("all"), F.max(F.struct("n", "comp")).alias("most"))
    sizes = sizes.select(
        "cluster",
        F.col("most.comp").alias("most"),
        F.ceil(F.col("all") / BLOCK).cast("int").alias("wide"),
        F.ceil((F.col("all") - F.col("most.n")) / BLOCK).cast("int").alias("asking"),
    )
    members = materialize(members.join(sizes, "cluster"))
    asked = materialize(members.select("doc").distinct())
    members = members.join(narrowed(texts.select(F.col("doc_id").alias("doc"), "text"), asked, "doc"), "doc")
    at = lambda n: F.pmod(F.xxhash64("doc"), F.col(n).cast("long")).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    shape = ["cluster", "doc", "comp", "sign", "text"]
    asks = members.filter("comp <> most").select(*shape, F.lit(True).alias("ask"), at("asking").alias("i"), every("wide").alias("j"))
    data = members.select(*shape, F.lit(False).alias("ask"), at("wide").alias("j"), every("asking").alias("i"))
    return asks.unionByName(data).groupBy("cluster", "i", "j").applyInPandas(lambda rows: _cross(rows, k, percent), "a long, b long")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Groups of near duplicates: one row for each row of docs (doc_id, text, ...).

    Returns doc_id, n_shingles (distinct k-word shingles of the lower-cased text), component_id (the
    smallest doc_id reachable over links) and kept (doc_id = component_id). A link is a pair whose
    shingle sets meet 100 * intersection >= percent * union, checked on the full sets.

    Texts that are null, empty or blank have no shingles and link with nothing. Rows that repeat a
    doc_id are one node: a repeated id with another text joins both texts' groups. A null doc_id
    links with nothing, has a null component and is kept. Other columns are ignored.

    Equal sets are folded first, so a hot group of copies is one representative. Buckets are compared
    with their smallest and largest member; what these stars leave in different components is compared with one
    another in blocks. No pair is dropped by a cap.
    """
    ship(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    own = materialize(
        texts.mapInArrow(
            lambda it: _sketches(it, k),
            "doc_id long, n_shingles long, low long, high long, sign binary",
        )
    )
    nodes = own.filter("doc_id is not null and n_shingles > 0")
    sets = nodes.groupBy("low", "high", "n_shingles").agg(F.min("doc_id").alias("doc"))
    members = nodes.select("doc_id", "low", "high", "n_shingles").join(sets, ["low", "high", "n_shingles"])
    members = materialize(members.select("doc_id", "doc").distinct())
    reps = sets.select(F.col("doc").alias("doc_id"), "low", "high", "n_shingles")
    kept = materialize(
        own.join(reps, ["doc_id", "low", "high", "n_shingles"]).dropDuplicates(["doc_id", "low", "high", "n_shingles"])
        .select(F.col("doc_id").alias("doc"), "n_shingles", "sign")
    )
    # a band's key is a hash of its rows' bytes of the sketch
    key = lambda band: F.xxhash64(band, F.substring("sign", band * ROWS + 1, F.lit(ROWS)))
    entries = kept.select("doc", F.explode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), key)).alias("key"))
    buckets = entries.groupBy("key").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).filter("lo < hi")
    crowded = materialize(entries.join(buckets, "key"))
    hubs = F.when(F.col("doc") < F.col("hi"), F.array("lo", "hi")).otherwise(F.array("lo"))
    stars = crowded.filter("doc > lo").select(F.col("doc").alias("a"), F.explode(hubs).alias("b")).distinct()
    close = materialize(_close(stars, kept))
    let_go()
    found = materialize(_confirm(close, kept, texts, k, percent))
    let_go(close)
    # two rounds leave few labels; what they leave apart is joined at the end
    merged = contract(found, rounds=2)
    more = _across(kept, crowded, labels(merged), texts, k, percent)
    # ids that stand for several texts join their sets
    several = members.groupBy("doc_id").agg(F.min("doc").alias("b"), F.max("doc").alias("a")).filter("b < a")
    several = members.join(several.select("doc_id", "b"), "doc_id").select(F.col("doc").alias("a"), "b")
    whole = components(merged.unionByName(more).unionByName(several))
    let_go(kept, found)
    members = members.groupBy("doc_id").agg(F.min("doc").alias("node")).join(whole, "node", "left")
    groups = members.select("doc_id", F.coalesce("component", "node").alias("component"))
    return (
        own.join(groups, "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("kept", F.col("component_id").isNull() | (F.col("doc_id") == F.col("component_id")))
    )
