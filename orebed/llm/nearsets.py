"""Near-duplicate documents by SuperMinHash over word shingles.

A shingle puts a rank into every slot of a signature along its own permutation
of the slots, so the ranks of one shingle are correlated and the signature has
less variance than independent minima. Ranks grow level by level; a document
stops once every slot holds a rank of the current level or below, because later
levels cannot lower any.

Equal shingle sets first collapse to one class. Bands of slots form buckets. Every
member of a bucket meets the bucket's first document, which settles most copies with
as many comparisons as there are members. Buckets whose members then still belong to
different components are compared block by block inside tasks: whole signatures
first, and where these do not disagree far beyond the threshold's noise, the full
sets. A task gives back one link per member at most, so pairs are never listed, and
a large bucket is many tasks. Links become components by label passing.

Defined results: a null or empty text, or one of blanks, has the empty set and is
linked with nothing; texts shorter than a shingle are one shingle; repeated rows
and rows that share an id are separate rows of one class each; null ids count as
largest; an empty table gives an empty result; other columns are ignored or, in
``keep_one``, kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebed.llm.common import cut, tasks_for
from orebed.operators.components import connected_components
from orebed.session import release

SLOTS = 127  # prime: x -> a x + c permutes the slots, and any two slots are dealt like a uniform pair
BANDS, ROWS = 25, 5  # misses a pair at similarity 0.8 with probability 5e-5
LEAST_AGREEMENT = 80  # of 127 slots; at similarity 0.8 fewer agree with probability 3e-6
BLOCK_ROWS = 512  # members of one side of a comparison task
REMEMBERED = 200_000  # words whose hashes a task remembers before it starts over
LEVEL_BITS = np.uint64(56)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit counter-based generator."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class ShingleSets:
    """Sorted distinct 64-bit shingle hashes of texts."""

    def __init__(self, size: int):
        self.size, self.memo = size, {}

    def _chain(self, words: np.ndarray, count: int, size: int) -> np.ndarray:
        out = np.full(count, size, np.uint64)
        for k in range(size):
            out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + words[k : k + count])
        return out

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        split = [t.encode().lower().split() if t else [] for t in texts]
        if len(self.memo) > REMEMBERED:
            self.memo = {}
        memo = self.memo
        for word in set().union(*split).difference(memo):
            memo[word] = xxhash.xxh3_64_intdigest(word)
        flat = np.array([h for words in split for h in map(memo.__getitem__, words)], np.uint64)
        ends = np.cumsum([len(w) for w in split])
        k = self.size
        whole = self._chain(flat, len(flat) - k + 1, k) if len(flat) >= k else np.empty(0, np.uint64)
        out = []
        for end, words in zip(ends.tolist(), split, strict=True):
            n = len(words)
            if n >= k:
                out.append(np.unique(whole[end - n : end - k + 1]))
            else:
                out.append(self._chain(flat[end - n : end], 1, n) if n else np.empty(0, np.uint64))
        return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """SuperMinHash of each set as rows of SLOTS values: the level in the top bits, a random fraction below."""
    held = np.full(len(sets) * SLOTS, np.iinfo(np.uint64).max, np.uint64)
    if not len(sets):
        return held.reshape(0, SLOTS)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    elements = np.concatenate(sets)
    seed = _mix(elements + np.uint64(0x632BE59BD9B4E019))
    step = (1 + (seed >> np.uint64(32)) % np.uint64(SLOTS - 1)).astype(np.int64)
    place = ((seed & np.uint64(0xFFFFFFFF)) % np.uint64(SLOTS)).astype(np.int64)
    for level in range(SLOTS):
        value = _mix(elements + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)) >> np.uint64(8)
        np.minimum.at(held, owner * SLOTS + place, value | (np.uint64(level) << LEVEL_BITS))
        place = (place + step) % SLOTS
        open_ = (held.reshape(-1, SLOTS).max(axis=1) >> LEVEL_BITS) > level
        stay = open_[owner]
        if not stay.any():
            break
        if not stay.all():
            owner, elements, step, place = owner[stay], elements[stay], step[stay], place[stay]
    return held.reshape(-1, SLOTS)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit bucket key per set and band."""
    used = signature[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), used.shape[:2]).copy()
    for r in range(ROWS):
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + used[:, :, r])
    return key.view(np.int64)


def _text_key(text: Column) -> Column:
    return F.xxhash64(text)


def sketch(docs: DataFrame, size: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, n_shingles, digest, bands, signature) of every row; a narrow pass."""
    rows = docs.select(F.col(id_col).alias("doc_id"), _text_key(F.col(text_col)).alias("text_key"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sets_of = ShingleSets(size)
        for batch in batches:
            for low in range(0, len(batch), 256):
                part = batch.iloc[low : low + 256]
                sets = sets_of(list(part["text"]))
                full = [s for s in sets if len(s)]
                made = signatures(full)
                keys, low_bytes = band_keys(made), (made & np.uint64(0xFF)).astype(np.uint8)
                at = iter(range(len(full)))
                where = [next(at) if len(s) else None for s in sets]
                yield pd.DataFrame({
                    "doc_id": part["doc_id"], "text_key": part["text_key"],
                    "n_shingles": [len(s) for s in sets],
                    "digest": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                    "bands": [None if k is None else keys[k] for k in where],
                    "signature": [None if k is None else low_bytes[k].tobytes() for k in where],
                })

    return rows.mapInPandas(
        run, f"doc_id {kind}, text_key long, n_shingles long, digest binary, bands array<long>, signature binary")


def _common(first: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Elements that each of the sorted sets ``others`` shares with ``first``."""
    flat = np.concatenate(others)
    at = np.searchsorted(first, flat)
    hit = first[np.minimum(at, len(first) - 1)] == flat
    return np.add.reduceat(hit, np.cumsum([0] + [len(o) for o in others[:-1]]), dtype=np.int64)


def element_sets(docs: DataFrame, wanted: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """(cid, elements) of the classes in ``wanted`` (cid, first_id, text_key): full sets, as bytes."""
    source = docs.select(F.col(id_col).alias("first_id"), F.col(text_col).alias("text")).withColumn("text_key", _text_key(F.col("text")))
    match = source["first_id"].eqNullSafe(wanted["first_id"]) & (source["text_key"] == wanted["text_key"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sets_of = ShingleSets(size)
        for batch in batches:
            for low in range(0, len(batch), 256):
                part = batch.iloc[low : low + 256]
                yield pd.DataFrame({"cid": part["cid"], "elements": [s.tobytes() for s in sets_of(list(part["text"]))]})

    return source.join(wanted, match).select("cid", "text").dropDuplicates(["cid"]).mapInPandas(run, "cid long, elements binary")


def _confirmed(pairs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the pairs whose full sets reach the threshold; sizes and signatures are looked at first."""
    side = lambda c: classes.select(
        F.col("cid").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("signature").alias(f"s_{c}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b").where(
        F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)

    def agree(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                a, b = (np.frombuffer(b"".join(batch[c]), np.uint8).reshape(-1, SLOTS) for c in ("s_a", "s_b"))
                yield batch.loc[(a == b).sum(axis=1) >= LEAST_AGREEMENT, ["a", "b"]]

    likely = cut(joined.mapInPandas(agree, "a long, b long"))
    full = lambda c: sets.select(F.col("cid").alias(c), F.col("elements").alias(f"e_{c}"))
    both = likely.join(full("b"), "b").join(full("a"), "a").select("a", "b", "e_a", "e_b")

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for a, b, left, right in zip(batch["a"], batch["b"], batch["e_a"], batch["e_b"], strict=True):
                first, second = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                shared = int(_common(first, [second])[0])
                if 100 * shared >= percent * (len(first) + len(second) - shared):
                    found.append((a, b))
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return both.mapInPandas(check, "a long, b long")


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest row of each component of n rows linked by (i, j)."""
    root = np.arange(n)
    while True:
        low, after = np.minimum(root[i], root[j]), root.copy()
        np.minimum.at(after, i, low)
        np.minimum.at(after, j, low)
        after = after[after]
        if (after == root).all():
            return root
        root = after


def _compare_blocks(run: pd.DataFrame, percent: int) -> pd.DataFrame:
    """(a, b) links that connect what one task's rows (a bucket, or two blocks of it) link."""
    n = len(run)
    signature = np.frombuffer(b"".join(run["signature"]), np.uint8).reshape(n, SLOTS)
    bands = np.array(run["bands"].tolist(), np.int64).reshape(n, BANDS)
    sets = [np.frombuffer(e, np.uint64) for e in run["elements"]]
    sizes, component = np.array([len(x) for x in sets]), run["component"].to_numpy("int64")
    side, band = run["side"].to_numpy(), int(run["band"].iloc[0])
    crossed = run["i"].iloc[0] != run["j"].iloc[0]
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1) if crossed else left
    firsts, seconds = [], []
    for i in left:
        j = right if crossed else right[right > i]
        j = j[(component[j] != component[i])
              & (100 * np.minimum(sizes[j], sizes[i]) >= percent * np.maximum(sizes[j], sizes[i]))]
        j = j[(signature[j] == signature[i]).sum(axis=1) >= LEAST_AGREEMENT]
        # a pair is looked at in the first of its common buckets
        j = j[(bands[j] == bands[i]).argmax(axis=1) == band]
        if len(j):
            shared = _common(sets[i], [sets[k] for k in j])
            j = j[100 * shared >= percent * (sizes[i] + sizes[j] - shared)]
            firsts += [i] * len(j)
            seconds += j.tolist()
    root = _roots(n, np.array(firsts, np.int64), np.array(seconds, np.int64))
    cid = run["cid"].to_numpy("int64")
    out = pd.DataFrame({"a": cid, "b": cid[root]})
    return out[out["a"] != out["b"]]


def _across(apart: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) links between members of one bucket and different components; apart: (bucket, band, cid, component, size)."""
    blocks = F.ceil(F.col("size") / BLOCK_ROWS)
    own = F.pmod(F.xxhash64("cid", "bucket"), blocks)
    placed = apart.select("bucket", "band", "cid", "component", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    dealt = placed.select(
        "bucket", "band", "cid", "component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        (F.col("own") > F.col("other")).cast("int").alias("side"))
    full = dealt.join(classes.select("cid", "signature", "bands"), "cid").join(sets, "cid")
    keys = ["bucket", "i", "j"]
    ordered = full.repartition(tasks_for(classes), *keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, key = [], None
        for batch in batches:
            for k, part in batch.groupby(keys, sort=False):
                if k != key and held:
                    yield _compare_blocks(pd.concat(held), percent)
                    held = []
                key = k
                held.append(part)
        if held:
            yield _compare_blocks(pd.concat(held), percent)

    return ordered.mapInPandas(run, "a long, b long")


def _grown(labels: DataFrame | None, edges: DataFrame) -> DataFrame:
    """Component labels (cid, component) after more links."""
    links = edges
    if labels is not None:
        links = links.unionByName(labels.where("cid <> component").select(
            F.col("cid").alias("a"), F.col("component").alias("b")))
    nodes = links.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    return connected_components(nodes, links).select(F.col("id").alias("cid"), F.col("label").alias("component"))


def _linked_classes(docs: DataFrame, classes: DataFrame, size: int, percent: int, id_col: str, text_col: str) -> DataFrame | None:
    """(cid, component) of the classes that have links."""
    bands = classes.select("cid", "first_id", F.posexplode("bands").alias("band", "bucket"))
    heads = bands.groupBy("bucket").agg(
        F.count("*").alias("size"), F.coalesce(F.min_by("cid", "first_id"), F.min("cid")).alias("pivot")).where("size > 1")
    members = cut(bands.join(heads, "bucket").select("bucket", "band", "cid", "pivot"))
    if members.isEmpty():
        return None
    wanted = classes.join(members.select("cid").distinct(), "cid").select("cid", "first_id", "text_key")
    sets = cut(element_sets(docs, wanted, size, id_col, text_col))
    pairs = members.where("cid <> pivot").select(F.col("pivot").alias("a"), F.col("cid").alias("b")).distinct()
    edges = cut(_confirmed(pairs, classes, sets, percent))
    labels = cut(_grown(None, edges))
    now = members.join(labels, "cid", "left").select("bucket", "band", "cid", F.coalesce("component", "cid").alias("component"))
    open_ = now.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size")).where("low < high")
    more = cut(_across(now.join(open_.select("bucket", "size"), "bucket"), classes, sets, percent))
    release(members, sets, edges)
    return labels if more.isEmpty() else _grown(labels, more)


def near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, text_key, n_shingles, group, component_id) of every row.

    Documents are linked when 100 * common shingles >= ``percent`` * all shingles.
    ``component_id`` is the smallest id reachable; ``group`` names the component
    and is null for empty sets.
    """
    rows = cut(sketch(docs, size, id_col, text_col))
    first = F.min_by(F.struct("text_key"), F.struct(F.col("doc_id").isNull(), "doc_id", "text_key"))
    classes = cut(rows.where("digest is not null").groupBy("digest").agg(
        F.min("doc_id").alias("first_id"), first.alias("first"), F.first("n_shingles").alias("n_shingles"),
        F.first("bands").alias("bands"), F.first("signature").alias("signature"),
    ).select("digest", "first_id", F.col("first.text_key").alias("text_key"), "n_shingles", "bands", "signature",
             F.monotonically_increasing_id().alias("cid")))
    labels = _linked_classes(docs, classes, size, percent, id_col, text_col)
    named = classes.select("digest", "cid", "first_id")
    if labels is not None:
        smallest = labels.join(named, "cid").groupBy("component").agg(F.min("first_id").alias("least"))
        found = labels.join(smallest, "component").select("cid", "component", "least")
        named = named.join(found, "cid", "left").select(
            "digest", F.coalesce("component", "cid").alias("group"),
            F.when(F.col("component").isNull(), F.col("first_id")).otherwise(F.col("least")).alias("component_id"))
    else:
        named = named.select("digest", F.col("cid").alias("group"), F.col("first_id").alias("component_id"))
    full = rows.where("digest is not null").select("doc_id", "text_key", "n_shingles", "digest").join(named, "digest").drop("digest")
    empty = rows.where("digest is null").select(
        "doc_id", "text_key", "n_shingles", F.lit(None).cast("long").alias("group"), F.col("doc_id").alias("component_id"))
    return full.unionByName(empty)


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Rows of ``docs`` without near-duplicates: of each component one row of the smallest id; empty texts stay."""
    judged = near_duplicates(docs, size, percent)
    kept = judged.where("group is not null and doc_id <=> component_id").groupBy("group").agg(
        F.min(F.struct("doc_id", "text_key")).alias("k")).select(F.xxhash64("k.doc_id", "k.text_key").alias("row_key"))
    keyed = docs.select(F.struct("*").alias("row"), _text_key(F.col("text")).alias("text_key"))
    keyed = keyed.select("row", F.xxhash64("row.doc_id", "text_key").alias("row_key"))
    blank = F.coalesce(F.trim(F.regexp_replace("row.text", r"[\x20\x09-\x0D]+", " ")), F.lit("")) == ""
    stay = keyed.where(~blank).join(kept.distinct(), "row_key", "left_semi").groupBy("row_key").agg(F.first("row").alias("row"))
    return stay.select("row.*").unionByName(keyed.where(blank).select("row.*"))
