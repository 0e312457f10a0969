"""Embedding near-duplicates by NN-descent.

Every distinct vector keeps a short list of its nearest neighbours found so far.
Lists start from buckets of random hyperplane codes. In each round the neighbours and
reverse neighbours of a vector meet (neighbours of neighbours) and improve their
lists; only vectors whose surroundings changed take part again. A list that holds
nothing but links is saturated: it is enlarged to all of its group, in blocks, so
that every link inside a group is counted, and to the saturated vectors of all groups
near enough (two full lists may leave out a link between them; a list that ends below
the threshold leaves out none). A sample compared with all vectors audits the recall;
while it is too low, lists and tables grow and descent goes on, and if that does not
suffice all pairs are compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import written
from starloom.llm.graph import block_pairs, connected_components, grouped, spanning

_SLACK = 1e-4  # the descent compares in single precision
_CHECKED = "rep long, links long, low long"


@dataclass(frozen=True)
class Settings:
    """``neighbours``: length of the lists; ``tables``: hyperplane codes they start from;
    ``bucket``: members compared at once in a bucket or around a vector; ``rounds``:
    of descent before an audit; ``quiet``: share of list entries that must change for
    another round; ``audit``: vectors compared with all; ``recall``: wanted share of
    their links; ``extra``: times that the lists are doubled, and as many tables added,
    before all pairs are compared; ``block``: members of a block of a group."""

    neighbours: int = 8
    tables: int = 12
    bucket: int = 48
    rounds: int = 4
    quiet: float = 0.01
    audit: int = 512
    recall: float = 0.98
    extra: int = 3
    block: int = 512


def _units(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Unit vectors in both precisions and a 128-bit name of the vector; vectors that
    cannot link get none."""
    for batch in batches:
        rows = []
        for values in batch["embedding"]:
            v = None if values is None else np.array([np.nan if x is None else x for x in values], np.float64)
            norm = 0.0 if v is None or not len(v) or not np.isfinite(v).all() else float(np.linalg.norm(v / np.abs(v).max())
                                                                                      if v.any() else 0.0)
            if not norm:
                rows.append((None, None, None, None, None))
                continue
            unit = v / np.abs(v).max() / norm
            name = hashlib.blake2b(unit.tobytes(), digest_size=16).digest()
            rows.append((*np.frombuffer(name, np.int64).tolist(), len(v), unit.tobytes(), unit.astype(np.float32).tobytes()))
        # object columns: with a null beside them 64-bit numbers would turn into floats
        out = pd.DataFrame(rows, columns=["name_a", "name_b", "dim", "v64", "v32"], dtype=object)
        out.insert(0, "vec_id", batch["vec_id"].to_numpy())
        yield out.astype({"name_a": "Int64", "name_b": "Int64", "dim": "Int32"})


def _codes(tables: int, bits: int, attempt: int):
    """The bucket of each vector in every table."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, rows in batch.groupby("dim"):
                x = np.frombuffer(b"".join(rows["v32"]), np.float32).reshape(-1, dim)
                planes = np.random.default_rng([7 + attempt, int(dim)]).standard_normal((dim, tables * bits)).astype(np.float32)
                signs = (x @ planes > 0).reshape(-1, tables, bits)
                code = signs @ (1 << np.arange(bits, dtype=np.int64))
                ids = np.repeat(rows["rep"].to_numpy(), tables)
                table = np.tile(np.arange(tables), len(rows))
                yield pd.DataFrame({"rep": ids, "pivot": ((code.ravel() << 8) + table << 16) + int(dim)})

    return run


def _meet(neighbours: int):
    """The nearest members of each member of a group that beat its list."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in grouped(batches, ["pivot", "part"]):
            ids, least, data = rows["rep"].to_numpy(), rows["least"].to_numpy(), rows["v32"].to_numpy()
            pivot, part = rows["pivot"].to_numpy(), rows["part"].to_numpy()
            new = np.flatnonzero((pivot[1:] != pivot[:-1]) | (part[1:] != part[:-1])) + 1
            out_u, out_w, out_s = [], [], []
            for a, b in zip([0, *new.tolist()], [*new.tolist(), len(rows)]):
                if b - a < 2:
                    continue
                x = np.frombuffer(b"".join(data[a:b]), np.float32).reshape(b - a, -1)
                s = x @ x.T
                np.fill_diagonal(s, -2)
                if b - a - 1 > neighbours:
                    cut = np.partition(s, -neighbours, axis=1)[:, -neighbours]
                    better = s >= np.maximum(cut, least[a:b])[:, None]
                else:
                    better = s >= least[a:b, None]
                    np.fill_diagonal(better, False)
                u, w = np.nonzero(better)
                out_u.append(ids[a + u])
                out_w.append(ids[a + w])
                out_s.append(s[u, w])
            if out_u:
                yield pd.DataFrame({"u": np.concatenate(out_u), "w": np.concatenate(out_w), "s": np.concatenate(out_s)})

    return run


def _exact(threshold: float):
    """Links within each block pair, in double precision."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in grouped(batches, ["component", "a", "b"]):
            for (_, a, b), group in rows.groupby(["component", "a", "b"], sort=False):
                x = np.frombuffer(b"".join(group["v64"]), np.float64).reshape(len(group), -1)
                linked = x @ x.T >= threshold
                np.fill_diagonal(linked, False)
                if a != b:
                    block = group["block"].to_numpy()
                    linked &= block[:, None] != block[None, :]
                ids = group["rep"].to_numpy()
                yield pd.DataFrame({"rep": ids, "links": linked @ group["copies"].to_numpy(),
                                    "low": ids[spanning(len(ids), *np.nonzero(linked))]})

    return run


def _balls(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A centre for each part of a group, and the widest angle of a member to it."""
    for rows in grouped(batches, ["component", "part"]):
        out = []
        for (component, part), group in rows.groupby(["component", "part"], sort=False):
            x = np.frombuffer(b"".join(group["v64"]), np.float64).reshape(len(group), -1)
            centre = x.sum(axis=0)
            norm = np.linalg.norm(centre)
            centre = centre / norm if norm > 0 else x[0]
            out.append((component, part, x.shape[1], centre.tobytes(), float(np.arccos(np.clip(x @ centre, -1, 1)).max())))
        yield pd.DataFrame(out, columns=["component", "part", "dim", "centre", "angle"])


def _close(threshold: float):
    """The pairs of balls of different groups that may hold a link (angles obey the
    triangle inequality)."""
    reach = float(np.arccos(np.clip(threshold, -1, 1))) + _SLACK

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in grouped(batches, ["dim", "a", "b"]):
            for (_, a, b), group in rows.groupby(["dim", "a", "b"], sort=False):
                x = np.frombuffer(b"".join(group["centre"]), np.float64).reshape(len(group), -1)
                angle, component = group["angle"].to_numpy(), group["component"].to_numpy()
                near = np.arccos(np.clip(x @ x.T, -1, 1)) <= angle[:, None] + angle[None, :] + reach
                near &= np.triu(component[:, None] != component[None, :])
                if a != b:
                    block = group["block"].to_numpy()
                    near &= block[:, None] != block[None, :]
                i, j = np.nonzero(near)
                part = group["part"].to_numpy()
                yield pd.DataFrame({"c0": component[i], "p0": part[i], "c1": component[j], "p1": part[j]})

    return run


def _audited(sample: dict[int, tuple[np.ndarray, np.ndarray]], threshold: float):
    """Links of the sampled vectors to the rows of a task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, rows in batch.groupby("dim"):
                if int(dim) in sample:
                    ids, probe = sample[int(dim)]
                    x = np.frombuffer(b"".join(rows["v64"]), np.float64).reshape(-1, int(dim))
                    hit = (probe @ x.T >= threshold) & (ids[:, None] != rows["rep"].to_numpy()[None, :])
                    yield pd.DataFrame({"rep": ids, "true": hit @ rows["copies"].to_numpy()})

    return run


def _split(pairs: DataFrame, bucket: int, turn: int) -> DataFrame:
    """(pivot, rep, part): the members of a pivot in random parts of about ``bucket``."""
    parts = pairs.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / bucket).alias("parts"))
    part = F.pmod(F.xxhash64(F.lit(turn), "rep", "pivot"), F.col("parts")).cast("int")
    return pairs.join(parts, "pivot").select("pivot", "rep", part.alias("part"))


def _improve(members: DataFrame, reps: DataFrame, graph: DataFrame | None, neighbours: int, turn: int) -> DataFrame:
    """The lists after the members of each (pivot, part) have met."""
    known = reps.select("rep", "v32")
    if graph is None:
        known = known.withColumn("least", F.lit(-1.0).cast("float"))
    else:
        worst = (graph.groupBy("u").agg(F.min("s").alias("worst"), F.count(F.lit(1)).alias("held"))
                 .select(F.col("u").alias("rep"), F.when(F.col("held") >= neighbours, F.col("worst")).alias("worst")))
        known = known.join(worst, "rep", "left").select("rep", "v32", F.coalesce("worst", F.lit(-1.0)).cast("float").alias("least"))
    met = (members.join(known, "rep").repartition("pivot", "part").sortWithinPartitions("pivot", "part")
           .mapInPandas(_meet(neighbours), "u long, w long, s float"))
    found = met.groupBy("u", "w").agg(F.max("s").alias("s")).withColumn("born", F.lit(turn))
    if graph is not None:
        found = (found.unionByName(graph).groupBy("u", "w").agg(F.max("s").alias("s"), F.min("born").alias("born")))
    place = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("s"), "w"))
    return written(found.withColumn("place", place).where(F.col("place") <= neighbours).drop("place"), "graph")


def near_vectors(vectors: DataFrame, threshold: float = 0.9, settings: Settings = Settings(), id_col: str = "vec_id",
                 vector_col: str = "embedding") -> tuple[DataFrame, float]:
    """(one row per vector: vec_id, n_links, component_id, kept; audited recall).

    ``n_links``: other vectors with cosine >= ``threshold``, equal vectors included;
    ``component_id``: smallest id reachable over links; ``kept``: the vector is that one.
    Vectors that are null, empty, zero or hold null or non-finite components link with
    nothing, vectors of different lengths do not link. Rows that repeat an id are one
    vector (the smallest); rows without an id are left out; other columns are
    ignored; an empty table gives no rows (and recall 1).
    """
    rows = vectors.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"))
    schema = "vec_id long, name_a long, name_b long, dim int, v64 binary, v32 binary"
    units = written(rows.mapInPandas(_units, schema), "units")
    if not units.groupBy("vec_id").count().where("count > 1").isEmpty():
        units = written(rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding")).mapInPandas(_units, schema), "units")
    usable = units.where("dim is not null")
    classes = usable.groupBy("name_a", "name_b").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    reps = written(classes.join(usable.select(F.col("vec_id").alias("rep"), "dim", "v64", "v32"), "rep"), "vectors")
    size = reps.count()
    bits = int(np.clip(np.log2(max(size, 2) / (settings.bucket / 3)), 1, 40))
    neighbours, turn = settings.neighbours, 0
    graph = _improve(_split(_buckets(reps, settings, bits, 0), settings.bucket, 0), reps, None, neighbours, 0)
    for attempt in range(settings.extra + 1):
        for _ in range(settings.rounds):
            turn += 1
            both = graph.select(F.col("u").alias("pivot"), F.col("w").alias("rep"), "born").unionByName(
                graph.select(F.col("w").alias("pivot"), F.col("u").alias("rep"), "born"))
            changed = both.groupBy("pivot").agg(F.max("born").alias("born")).where(F.col("born") >= turn - 1).select("pivot")
            around = both.select("pivot", "rep").distinct().join(changed, "pivot")
            members = _split(around, settings.bucket, turn)
            own = members.select("pivot", F.col("pivot").alias("rep"), "part").distinct()
            graph = _improve(members.unionByName(own), reps, graph, neighbours, turn)
            if graph.where(F.col("born") == turn).count() <= settings.quiet * neighbours * size:
                break
        result = _linked(graph, reps, neighbours, threshold, settings)
        recall = _recall(result, reps, threshold, settings, size)
        if recall >= settings.recall:
            break
        if attempt < settings.extra:
            neighbours *= 2
            members = _split(_buckets(reps, settings, bits, attempt + 1), settings.bucket, turn)
            graph = _improve(members, reps, graph.withColumn("born", F.lit(turn)), neighbours, turn)
    else:
        result = _joined(_inside(reps.select("rep", F.col("dim").cast("long").alias("component")), reps, threshold,
                                 4 * settings.block))
        recall = 1.0  # all pairs are compared
    by_class = reps.select("name_a", "name_b", "rep", "copies").join(result, "rep", "left").select(
        "name_a", "name_b", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"))
    out = (units.select("vec_id", "name_a", "name_b").join(by_class, ["name_a", "name_b"], "left")
           .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                   F.coalesce("component_id", "vec_id").alias("component_id"))
           .withColumn("kept", F.col("component_id") == F.col("vec_id")))
    return out, recall


def _buckets(reps: DataFrame, settings: Settings, bits: int, attempt: int) -> DataFrame:
    """(rep, pivot): the vectors that share a bucket with another, in each table of an attempt."""
    buckets = written(reps.select("rep", "dim", "v32").mapInPandas(_codes(settings.tables, bits, attempt),
                                                                   "rep long, pivot long"), "codes")
    full = buckets.groupBy("pivot").agg(F.count(F.lit(1)).alias("held")).where("held > 1").drop("held")
    return buckets.join(full, "pivot")


def _inside(groups: DataFrame, reps: DataFrame, threshold: float, block: int) -> DataFrame:
    """(rep, links, low) of the block pairs inside each group of (rep, component)."""
    blocks = groups.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    members = groups.join(blocks, "component").join(reps.select("rep", "v64", "copies"), "rep")
    return block_pairs(members, ["component"], "blocks").mapInPandas(_exact(threshold), _CHECKED)


def _across(full: DataFrame, reps: DataFrame, threshold: float, block: int) -> DataFrame:
    """(rep, links, low) between the groups of (rep, component): the members of a group
    in parts, each a ball, and the parts compared whose balls are near enough."""
    parts = full.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / block).alias("parts"))
    part = F.pmod(F.xxhash64(F.lit("part"), "rep"), F.col("parts")).cast("int")
    held = written(full.join(parts, "component").join(reps.select("rep", "v64", "copies"), "rep")
                   .select("component", part.alias("part"), "rep", "v64", "copies"), "saturated")
    balls = written(held.repartition("component", "part").sortWithinPartitions("component", "part").mapInPandas(
        _balls, "component long, part int, dim int, centre binary, angle double"), "balls")
    tiles = balls.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("tiles"))
    placed = balls.join(tiles, "dim").withColumn("rep", F.xxhash64("component", "part"))
    pairs = written(block_pairs(placed, ["dim"], "tiles").mapInPandas(
        _close(threshold), "c0 long, p0 int, c1 long, p1 int").withColumn("pair", F.monotonically_increasing_id()), "pairs")
    sides = pairs.select("pair", F.explode(F.array(*[F.struct(
        F.col(f"c{n}").alias("component"), F.col(f"p{n}").alias("part"), F.lit(n).alias("block")) for n in (0, 1)])).alias("side"))
    members = (sides.select("pair", "side.*").join(held, ["component", "part"])
               .select(F.col("pair").alias("component"), F.lit(0).alias("a"), F.lit(1).alias("b"), "block", "rep", "v64", "copies"))
    return (members.repartition("component").sortWithinPartitions("component")
            .mapInPandas(_exact(threshold), _CHECKED))


def _joined(links: DataFrame) -> DataFrame:
    """(rep, links, component) of rows (rep, links, low)."""
    checked = written(links, "links")
    final = connected_components(checked.where("low <> rep").select(F.col("low").alias("u"), F.col("rep").alias("v")))
    return written(checked.groupBy("rep").agg(F.sum("links").alias("links"))
                   .join(final.withColumnRenamed("node", "rep"), "rep", "left"), "linked")


def _linked(graph: DataFrame, reps: DataFrame, neighbours: int, threshold: float, settings: Settings) -> DataFrame:
    """(rep, links, component): the exact links inside each group that the lists' links
    connect, and between the saturated vectors of different groups."""
    near = graph.where(F.col("s") >= threshold - _SLACK).select("u", F.col("w").alias("v"))
    groups = written(connected_components(near).withColumnRenamed("node", "rep"), "groups")
    full = (graph.groupBy(F.col("u").alias("rep")).agg(F.min("s").alias("worst"), F.count(F.lit(1)).alias("held"))
            .where((F.col("held") >= neighbours) & (F.col("worst") >= threshold - _SLACK)).select("rep"))
    return _joined(_inside(groups, reps, threshold, settings.block).unionByName(
        _across(groups.join(full, "rep"), reps, threshold, settings.block)))


def _recall(result: DataFrame, reps: DataFrame, threshold: float, settings: Settings, size: int) -> float:
    """Share of the links of a bounded sample, compared with every vector, that were
    found: the mean over the vectors of a group, then over the groups, so that a
    large group does not hide what others lack."""
    chosen = reps.where(F.pmod(F.xxhash64(F.lit("audit"), "rep"), F.lit(1 << 30))
                        < int(min(1.0, settings.audit / max(size, 1)) * (1 << 30))).select("rep", "dim", "v64").toPandas()
    probes = {int(dim): (rows["rep"].to_numpy(), np.frombuffer(b"".join(rows["v64"]), np.float64).reshape(len(rows), -1))
              for dim, rows in chosen.groupby("dim")}
    true = (reps.select("rep", "dim", "v64", "copies").mapInPandas(_audited(probes, threshold), "rep long, true long")
            .groupBy("rep").agg(F.sum("true").alias("true")).where(F.col("true") > 0))
    seen = (true.join(result, "rep", "left").groupBy(F.coalesce("component", "rep").alias("group"))
            .agg(F.avg(F.coalesce("links", F.lit(0)) / F.col("true")).alias("share")).agg(F.avg("share")).first()[0])
    return 1.0 if seen is None else float(seen)
