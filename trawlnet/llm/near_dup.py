"""Near-duplicate documents: MinHash bands for candidates, sequential Bayesian pruning, exact verification, components."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawlnet.llm.components import components
from trawlnet.llm.shared import as_text, spread_join, written
from trawlnet.llm.words import MinHash, buffers, minhash_sets, mix, shingle_sets, texts_words

#: Rows of ids or digests that may be broadcast: 40 bytes each, so at most about 20 MB.
BROADCAST_ROWS = 500_000
#: Keys of bands that are broadcast, 8 bytes each.
BROADCAST_KEYS = 2_000_000
#: Bits of one verification batch.
BATCH = 64


@dataclass(frozen=True)
class NearDup:
    """``shingle`` words, ``percent`` Jaccard similarity. A pair at the threshold shares one of ``bands`` bands of
    ``rows`` hashes with probability 1 - (1 - s^rows)^bands: 0.99993 for 24 of 5 at 0.8. Verification compares
    ``batches`` batches of 64 further hashes, one bit of each, and drops a pair once the posterior probability that
    its similarity reaches the threshold falls below ``miss``."""

    shingle: int = 5
    percent: int = 80
    bands: int = 24
    rows: int = 5
    batches: int = 3
    miss: float = 1e-5
    seed: int = 20_240_601

    def most_apart(self) -> list[int]:
        """For each batch, the most bits that may differ so far for a pair to go on.

        One bit of equal hashes is equal, of others by half: bits agree with probability p = (1 + s) / 2. The prior of s
        is uniform, so after m of n bits agree the posterior of p is Beta(m + 1, n - m + 1) on [1/2, 1], and
        P(p >= x) is proportional to P(Binomial(n + 1, x) <= m).
        """

        def tail(n: int, m: int, x: float) -> float:
            return sum(comb(n + 1, i) * x**i * (1 - x) ** (n + 1 - i) for i in range(m + 1))

        out = []
        for n in (BATCH * (i + 1) for i in range(self.batches)):
            m = next(m for m in range(n + 1) if tail(n, m, (1 + self.percent / 100) / 2) >= self.miss * tail(n, m, 0.5))
            out.append(n - m)
        return out

    def likely(self) -> str:
        """A SQL condition on ``sketch`` and ``other_sketch``, one batch after the other."""
        apart = [f"bit_count(sketch[{i}] ^ other_sketch[{i}])" for i in range(self.batches)]
        return " and ".join(f"{' + '.join(apart[: i + 1])} <= {most}" for i, most in enumerate(self.most_apart()))


def set_digest(values: np.ndarray) -> bytes:
    """16 bytes that two sets share only if they are equal."""
    with np.errstate(over="ignore"):
        a = np.bitwise_xor.reduce(mix(values + np.uint64(0x632BE59BD9B4E019)))
        b = np.add.reduce(mix(values ^ np.uint64(0x8CB92BA72F3D8DD7)))
    return int(a).to_bytes(8, "big") + int(b).to_bytes(8, "big")


SIGNATURES = "n_shingles long, set_id binary, bands array<long>, sketch array<long>"


def _signatures(spec: NearDup, keys: int):
    """Arrow batches of key columns and text to the keys, set size, set digest, band keys and verification hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = MinHash(spec.bands * spec.rows + spec.batches * BATCH, spec.seed)
        salt = mix(np.arange(1, spec.bands * spec.rows + 1, dtype=np.uint64)).reshape(spec.bands, spec.rows)
        for batch in batches:
            for part in text_parts(batch, keys):
                raw, offsets = buffers(part.column(keys))
                words, bounds = texts_words(raw, offsets)
                sets = list(shingle_sets(words, bounds, spec.shingle))
                full = [i for i, s in enumerate(sets) if len(s)]
                sizes = np.array([len(s) for s in sets], dtype=np.int64)
                ids, bands, sketches = [None] * len(sets), [None] * len(sets), [None] * len(sets)
                if full:
                    minima = minhash_sets([sets[i] for i in full], hashes)
                    split = spec.bands * spec.rows
                    rows = minima[:, :split].reshape(-1, spec.bands, spec.rows).astype(np.uint64)
                    keyed = mix(np.bitwise_xor.reduce(mix(rows + salt), axis=2) + salt[:, 0]).astype(np.int64)
                    bits = np.packbits(minima[:, split:] & 1, axis=1).view(np.int64)
                    for j, i in enumerate(full):
                        ids[i], bands[i], sketches[i] = set_digest(sets[i]), keyed[j], bits[j]
                made = [pa.array(sizes), pa.array(ids, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64()))]
                names = [*part.schema.names[:keys], "n_shingles", "set_id", "bands", "sketch"]
                yield pa.record_batch([*part.columns[:keys], *made], names=names)

    return run


def text_parts(batch: pa.RecordBatch, text: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes of text, one row at least."""
    _, offsets = buffers(batch.column(text))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def _sets(shingle: int):
    """Arrow batches of texts to ``set_id, shingles``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_parts(batch, 0):
                words, bounds = texts_words(*buffers(part.column(0)))
                sets = [s for s in shingle_sets(words, bounds, shingle) if len(s)]
                places = np.cumsum([0] + [len(s) for s in sets])
                flat = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
                made = [
                    pa.array([set_digest(s) for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(flat)),
                ]
                yield pa.record_batch(made, names=["set_id", "shingles"])

    return run


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough; ``sets`` has ``set_id, shingles``."""
    pairs = written(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "likely-pairs")
    a_set, b_set = (sets.select(F.col("set_id").alias(x), F.col("shingles").alias(f"set_{x}")) for x in ("a", "b"))
    full = pairs.join(b_set, "b").join(a_set, "a")
    both = F.size(F.array_intersect("set_a", "set_b")).cast("long")
    every = F.size("set_a").cast("long") + F.size("set_b") - F.col("both")
    full = full.withColumn("both", both).where(100 * F.col("both") >= percent * every)
    return written(full.select("a", "b"), "links")


def shared_bands(classes: DataFrame) -> DataFrame:
    """A row for each class (``set_id, n, bands`` and more) and band that it shares with another class.

    Most keys of bands occur once. The keys are counted alone; those found twice are sent to the classes while their
    number is within bounds, so that the classes need no shuffle, and joined to narrow rows beyond.
    """
    keys = classes.select(F.explode("bands").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    keys = written(keys.where("n > 1").select("key"), "shared-keys")
    if keys.count() <= BROADCAST_KEYS:
        rows = classes.select("*", F.posexplode("bands").alias("band", "key")).join(F.broadcast(keys), "key", "left_semi")
    else:
        rows = classes.select("set_id", F.posexplode("bands").alias("band", "key")).join(keys, "key").join(classes, "set_id")
    return written(rows, "buckets")


def _split_buckets(members: DataFrame, named: DataFrame) -> DataFrame:
    """Members of the buckets that span several components, with their own ``component`` and the bucket's largest one,
    ``main``."""
    placed = members.join(named.select(F.col("node").alias("set_id"), "component"), "set_id", "left")
    placed = written(placed.withColumn("component", F.coalesce("component", "set_id")), "placed")
    sizes = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("key").agg(F.max(F.struct("n", "component")).alias("main"), F.count(F.lit(1)).alias("parts"))
    main = main.where("parts > 1").select("key", F.col("main.component").alias("main"))
    return placed.join(main, "key")


def _alike(percent: int) -> str:
    """Sets whose sizes alone rule the similarity out need no comparison: it is at most the ratio of the sizes."""
    return f"100 * least(n, other_n) >= {percent} * greatest(n, other_n)"


def _first_shared(bands: int | None) -> str:
    """Two classes meet in each band that they share: true in the first one. ``bands``: places to look at one by one, which
    costs less than lists where they are few."""
    if bands is None:
        return "not arrays_overlap(slice(bands, 1, band), slice(other_bands, 1, band))"
    return " and ".join(["true", *(f"(band <= {i} or bands[{i}] <> other_bands[{i}])" for i in range(bands - 1))])


def linked_classes(
    members: DataFrame, sets: DataFrame, percent: int, likely: str = "true", sketch: tuple[str, ...] = (), bands: int | None = None
) -> DataFrame:
    """``node, component`` of the classes with a link; every link between classes that share a band counts.

    ``members`` come from ``shared_bands``, ``sets`` has their ``set_id, shingles``; ``likely`` is a condition on the
    columns ``sketch`` and ``other_<sketch>`` that rules pairs out before their sets are compared; ``bands`` is their
    number, where each holds keys of its own. Keys with one member are passed over.

    A bucket of n classes would have n * (n - 1) / 2 pairs. Instead each class meets the hub of its bucket first. With
    those links known, pairs inside one component need no comparison. In the second round the hubs are left out, and the
    classes outside a bucket's largest component meet all classes of other components there, so no link between
    components is left out; pairs are compared inside the join, sketches before sets, and only links leave it.
    """

    hub = F.min(F.struct(F.col("set_id").alias("other"), *[F.col(c).alias(f"other_{c}") for c in ("n", *sketch)]))
    hubs = members.groupBy("key").agg(hub.alias("hub"), F.count(F.lit(1)).alias("rows")).where("rows > 1").select("key", "hub.*", "rows")
    around = written(members.join(hubs, "key").where("set_id <> other"), "around-hubs")
    met = around.where(f"{_alike(percent)} and {likely}")
    links = verified(met.select(F.col("set_id").alias("a"), F.col("other").alias("b")), sets, percent)
    named = written(components(links), "components")
    # every pair with a hub has been compared
    others = around.where("rows > 2").select(*members.columns)
    split = written(_split_buckets(others, named).join(sets, "set_id"), "split-buckets")
    theirs = [F.col(c).alias(f"other_{c}") for c in ("n", *sketch, "component", "bands", "shingles")]
    rest = split.select("key", F.col("set_id").alias("other"), *theirs)
    # minority rows of a bucket meet all its rows, two minority rows once, and a pair in the first band that it shares
    once = "component <> other_component and (other_component = main or set_id < other)"
    alike = f"{100 + percent} * size(array_intersect(shingles, other_shingles)) >= {percent} * (n + other_n)"
    met = split.where("component <> main").join(rest, "key").where(" and ".join([once, _alike(percent), _first_shared(bands), likely, alike]))
    more = written(met.select(F.col("set_id").alias("a"), F.col("other").alias("b")), "links")
    return named if more.isEmpty() else written(components(links.union(more)), "components")


def near_duplicates(
    docs: DataFrame, spec: NearDup = NearDup(), id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``, the columns ``carry`` and ``group``, a
    digest that names the component whatever its ids are; it is null where there are no words.

    Texts are lower-cased in A-Z and cut into words; a document's set holds its distinct shingles, or all its words as
    one when there are fewer. Documents with similarity ``percent`` or more are linked, and a component is named by
    its smallest id. Equal sets are one class from the start, so copies cost nothing more.

    A null or wordless text has an empty set, no links and its own id as component. A null id is below no other: it
    names its component only if all ids in it are null, and such a row is kept. Rows that repeat an id each give a row;
    those of a component's smallest id are all kept. Other columns are ignored; an empty table gives no rows.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), *carry, as_text(F.col(text_col)).alias("text"))
    keys = texts.drop("text").schema
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keys), SIGNATURES])
    signed = written(texts.mapInArrow(_signatures(spec, len(keys)), schema), "signatures")
    classes = (
        signed.where("set_id is not null")
        .groupBy("set_id")
        .agg(
            F.min("doc_id").alias("low"),
            F.any_value("n_shingles").alias("n"),
            F.any_value("bands").alias("bands"),
            F.any_value("sketch").alias("sketch"),
        )
    )
    classes = written(classes, "classes")
    members = shared_bands(classes)
    named = linked_classes(members, _needed_sets(texts, members, spec), spec.percent, spec.likely(), ("sketch",))
    lows = named.join(classes.select(F.col("set_id").alias("node"), "low"), "node")
    lowest = lows.groupBy("component").agg(F.min("low").alias("component_id"))
    linked = lows.select(F.col("node").alias("set_id"), "component").join(lowest, "component")
    placed = classes.select("set_id", "low").join(linked, "set_id", "left")
    group = F.coalesce("component", "set_id").alias("group")
    placed = placed.select("set_id", F.coalesce("component_id", "low").alias("component_id"), group)
    out = spread_join(signed.select("doc_id", *carry, "n_shingles", "set_id"), placed, "set_id")
    out = out.withColumn("component_id", F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    return out.select("doc_id", *carry, "n_shingles", "component_id", kept, "group")


def _needed_sets(texts: DataFrame, members: DataFrame, spec: NearDup) -> DataFrame:
    """Full shingle sets of the classes that share a band with another one, once each."""
    ids = written(members.select(F.col("low").alias("doc_id")).distinct(), "needed")
    if ids.count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    wanted = texts.join(ids, texts["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi").select("text")
    sets = wanted.mapInArrow(_sets(spec.shingle), "set_id binary, shingles array<long>")
    return written(sets.groupBy("set_id").agg(F.any_value("shingles").alias("shingles")), "sets")
