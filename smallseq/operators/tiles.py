"""Hits of alignments and counts of features without pairs, by tiles of a chromosome.

For alignments of one length and strand, a match is an interval of their begins, or two places. So sums over a tile's begins
count the matches of each alignment, and sums over its alignments give what each match gets. Sums are of whole numbers: exact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..durable import durable, ship
from .select import PAIR, ROW, assign, candidate_pairs, choose, passes_for, with_hits, with_loci

#: Kinds of matches (rule and strand) up to which tiles are used: each is a bit of a long.
KINDS = 64
#: Places of a tile, and alignments of one beyond which several tasks share it (each with the tile's matches).
TILE, SLICE = 1024, 400_000
_OVERLAPS = ["partial", "nested", "exact", "anchored", "5' anchored", "3' anchored"]
_ANCHORED, _START, _END = 3, 6, 7
#: Binary places of the two whole numbers that a share is summed as.
_HIGH, _LOW = 20, 40
_SLOT = ["chrom", "__tile", "__salt"]


def _pieces(m: dict, codes, length: int, base: int):
    """(index, first, last): for alignments of this length, begins within the tile at which a match is met; twice for two places."""
    import numpy as np

    code = codes[m["kind"]]
    room, fits = m["fe"] - length, length <= m["fe"] - m["fs"]
    partial, at_end = code == 0, code == _END
    first = np.where(partial, m["fs"] - length + 1, np.where(at_end, room, m["fs"]))
    last = np.where(partial, m["fe"] - 1, np.where((code == 1) | at_end, room, m["fs"]))
    there = partial | (fits & ((code != 2) | (room == m["fs"])))
    again = np.flatnonzero((code == _ANCHORED) & fits & (room != m["fs"]))
    at = np.flatnonzero(there)
    at, first, last = np.concatenate([at, again]), np.concatenate([first[at], room[again]]) - base, np.concatenate([last[at], room[again]]) - base
    first, last = np.maximum(first, 0), np.minimum(last, TILE - 1)
    some = first <= last
    return at[some], first[some], last[some]


def _met(kind, first, last, n: int, weights=None):
    """(kinds x places): how many of the pieces lie over each place, or the sum of their weights."""
    import numpy as np

    row, size = kind * (TILE + 1), n * (TILE + 1)
    ends = np.bincount(row + first, weights, size) - np.bincount(row + last + 1, weights, size)
    return np.cumsum(ends.reshape(n, TILE + 1), axis=1)


def _groups(m: dict, a: dict, kinds: list, base: int, named: bool):
    """For each strand and length of a slice's alignments: their rows, and of each distinct (begin, mask) among them what it meets."""
    import numpy as np

    strand = [k["strand"] for k in kinds]
    level = np.array([k["hierarchy"] for k in kinds])[:, None]
    bits = np.arange(len(kinds), dtype=np.uint64)[:, None]
    lengths, of_length = np.unique(a["e"] - a["s"], return_inverse=True)
    order = np.argsort(of_length * 2 + a["fwd"], kind="stable")
    cuts = np.searchsorted((of_length * 2 + a["fwd"])[order], np.arange(2 * len(lengths) + 1))
    masks, of_mask = np.unique(a["mask"], return_inverse=True)
    for g in range(2 * len(lengths)):
        rows = order[cuts[g] : cuts[g + 1]]
        if not len(rows):
            continue
        length, fwd = int(lengths[g // 2]), bool(g % 2)
        codes = [_OVERLAPS.index(k["overlap"]) if k["overlap"] in _OVERLAPS else 8 for k in kinds]
        codes = [c if c < 4 or c > 5 else _ANCHORED if s is None else _START if (c == 4) == fwd else _END for c, s in zip(codes, strand, strict=True)]
        at, first, last = _pieces(m, np.array(codes), length, base)
        kind = m["kind"][at]
        n = _met(kind, first, last, len(kinds))
        keys, own = np.unique((a["s"][rows] - base) * len(masks) + of_mask[rows], return_inverse=True)
        places = keys // len(masks)
        n = n[:, places]
        levels = np.where((n > 0) & ((masks[keys % len(masks)].view(np.uint64)[None, :] >> bits) & np.uint64(1) > 0), level, np.iinfo(level.dtype).max)
        best = levels.min(axis=0)
        chosen = (levels == best) & (best < np.iinfo(level.dtype).max)
        n = np.where(chosen, n, 0)
        found = {"rows": rows, "own": own, "places": places, "chosen": chosen, "hits": n.sum(axis=0), "pieces": (at, kind, first, last)}
        if named:  # where each kind meets one match, the sum of the matches' numbers is that match's
            number = np.where(chosen, np.rint(_met(kind, first, last, len(kinds), m["number"][at])[:, places]).astype(np.int64), -1)
            highest, lowest = number.max(axis=0), np.where(chosen, number, np.iinfo(np.int64).max).min(axis=0)
            found["several"] = (n > 1).any(axis=0) | ((highest != lowest) & (found["hits"] > 0))
            found["number"] = np.where(found["several"] | (found["hits"] == 0), -1, highest)
        yield found


def _slices(batches):
    """The tables of each slice in turn, from batches sorted by slice."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    parts, before = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        here = [batch.column(batch.schema.get_field_index(c)) for c in _SLOT]
        new = np.zeros(batch.num_rows, bool)
        for x in here:
            x = pc.fill_null(x, "\0" if pa.types.is_string(x.type) else -1)
            new[1:] |= pc.not_equal(x[1:], x[:-1]).to_numpy(zero_copy_only=False)
        starts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for i, (start, end) in enumerate(zip(starts, starts[1:], strict=False)):
            slot = tuple(x[start].as_py() for x in here)
            if parts and slot != before:
                yield pa.Table.from_batches(parts).combine_chunks()
                parts = []
            before = slot
            parts.append(batch.slice(start, end - start))
    if parts:
        yield pa.Table.from_batches(parts).combine_chunks()


def _sides(table):
    """(matches, alignments, table of matches, table of alignments, first place) of a slice."""
    import numpy as np
    import pyarrow.compute as pc

    asked = pc.equal(table["__side"], 1)
    left, right = table.filter(asked), table.filter(pc.invert(asked))
    whole = lambda t, c: t[c].to_numpy() if len(t) else np.zeros(0, np.int64)
    m = {"kind": whole(right, "__kind").astype(np.int64), "fs": whole(right, "__from").astype(np.int64), "fe": whole(right, "__to").astype(np.int64)}
    a = {"s": whole(left, "__from").astype(np.int64), "e": whole(left, "__to").astype(np.int64), "mask": whole(left, "__mask").astype(np.int64)}
    a["fwd"] = whole(left, "__fwd").astype(np.int64)
    return m, a, right, left, int(table["__tile"][0].as_py() or 0) * TILE


def _summed(kinds: list, norm_hits: bool):
    """Batches of slices -> (library, feature_id, classifier, rule_idx, count) of each slice's alignments."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        rules = np.array([k["rule_idx"] for k in kinds], np.int32)
        for table in _slices(batches):
            m, a, right, left, base = _sides(table)
            if not len(right) or not len(left):
                continue
            libraries = left["library"].combine_chunks().dictionary_encode()
            library, n_libraries = libraries.indices.to_numpy(), len(libraries.dictionary)
            corr = left["__corr"].to_numpy()
            total = np.zeros((3, n_libraries, len(right)), np.int64)
            for g in _groups(m, a, kinds, base, False):
                hits = g["hits"][g["own"]]
                some = hits > 0
                own, rows, n = g["own"][some], g["rows"][some], len(g["places"])
                share = (corr[rows] / hits[some] if norm_hits else corr[rows]) * 2.0**_HIGH
                high = np.floor(share)
                low = np.rint((share - high) * 2.0**_LOW)
                key = library[rows].astype(np.int64) * n + own
                at, kind, first, last = g["pieces"]
                used = g["chosen"].any(axis=1)[kind]
                at, kind, first, last = at[used], kind[used], first[used], last[used]
                ks, us = np.nonzero(g["chosen"])
                flat = ks * (TILE + 1) + g["places"][us] + 1
                from_, to = kind * (TILE + 1) + first, kind * (TILE + 1) + last + 1
                for i, what in enumerate((high.astype(np.int64), low.astype(np.int64), np.ones(len(rows), np.int64))):
                    given = np.zeros(n_libraries * n, np.int64)
                    np.add.at(given, key, what)
                    for j, x in enumerate(given.reshape(n_libraries, n)):
                        upto = np.zeros(len(kinds) * (TILE + 1), np.int64)
                        np.add.at(upto, flat, x[us])
                        upto = np.cumsum(upto.reshape(len(kinds), -1), axis=1).ravel()
                        np.add.at(total[i, j], at, upto[to] - upto[from_])
            js, fs = np.nonzero(total[2])
            if len(js):
                high, low = total[0, js, fs], total[1, js, fs]
                high, low = high + (low >> _LOW), low & ((1 << _LOW) - 1)
                counts = high / 2.0**_HIGH + low / 2.0 ** (_HIGH + _LOW)
                picked = pa.array(fs)
                columns = [libraries.dictionary.take(pa.array(js)), right["feature_id"].combine_chunks().take(picked), right["classifier"].combine_chunks().take(picked), pa.array(rules[m["kind"][fs]]), pa.array(counts)]
                yield pa.RecordBatch.from_arrays(columns, ["library", *PAIR, "rule_idx", "count"])

    return run


def _named(kinds: list, keep: list[str]):
    """Batches of slices -> the alignments' columns ``keep`` with hits, feature (if it is the only one) and several."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for table in _slices(batches):
            m, a, right, left, base = _sides(table)
            if not len(left):
                continue
            features = right["feature_id"].combine_chunks().dictionary_encode()
            m["number"] = features.indices.to_numpy().astype(np.float64) if len(right) else np.zeros(0)
            hits, number, several = np.zeros(len(left), np.int64), np.full(len(left), -1), np.zeros(len(left), bool)
            for g in _groups(m, a, kinds, base, True) if len(right) else ():
                hits[g["rows"]], number[g["rows"]], several[g["rows"]] = (g[c][g["own"]] for c in ("hits", "number", "several"))
            feature = features.dictionary.take(pa.array(number, mask=number < 0)) if len(right) else pa.nulls(len(left), pa.string())
            columns = [left[c].combine_chunks() for c in keep] + [pa.array(hits), feature, pa.array(several)]
            out = pa.RecordBatch.from_arrays(columns, [*keep, "hits", "feature", "several"])
            for i in range(0, out.num_rows, 20_000):
                yield out.slice(i, 20_000)

    return run


class Tiled:
    """The tiles of some alignments and matches, and which alignments have to go by their pairs (``paired``)."""

    def __init__(self, alignments: DataFrame, matches: DataFrame, rules: DataFrame | None = None):
        """``rules``: the typed rules of the matches, which spares a pass over the matches to find them."""
        self.spark, self.matches = alignments.sparkSession, matches.where("fs < fe")
        several = F.count("*").over(Window.partitionBy(*PAIR)) > 1
        marked = durable(self.matches.where("chrom is not null").select(*PAIR, "chrom", "fs", "fe", "rule_idx", "strand", several.alias("several")))
        of_rule = ["rule_idx", "overlap", "hierarchy", "sense", "nts", "lengths", "mismatches"]
        found = marked.select("rule_idx", "strand").distinct().join(F.broadcast((self.matches if rules is None else rules).select(*of_rule).distinct()), "rule_idx")
        self.kinds = [k.asDict() for k in found.collect()]  # rules x strands
        self.usable = 0 < len(self.kinds) <= KINDS
        if not self.usable:
            return
        ship(self.spark)
        kind = F.coalesce(*[F.when((F.col("rule_idx") == k["rule_idx"]) & F.col("strand").eqNullSafe(F.lit(k["strand"]).cast("boolean")), i) for i, k in enumerate(self.kinds)])
        marked = marked.withColumn("kind", kind).drop("rule_idx", "strand")
        self.single, self.several = marked.where("not several"), marked.where("several")
        odd = F.count_if(~F.coalesce(F.col("s") < F.col("e"), F.lit(False)))
        stats = alignments.groupBy("chrom", self._tile("s").alias("tile")).agg(F.count("*").alias("n"), odd.alias("odd"), F.max(F.col("e") - F.col("s")).alias("longest"))
        stats = durable(stats)  # a row for each tile
        whole = stats.agg(F.max("longest").alias("longest"), F.sum("odd").alias("odd")).first()
        self.longest, self.odd = max(whole["longest"] or 0, 1), (whole["odd"] or 0) > 0
        # tiles of more than SLICE alignments: a bounded share of all
        self.hot = stats.where(F.col("n") > SLICE).select(F.col("chrom").alias("__c"), F.col("tile").alias("__t"), F.ceil(F.col("n") / SLICE).cast("int").alias("__slices"))
        self.any_several = not self.several.isEmpty()
        # equal keys have equal hashes
        self.any_twice = not alignments.select(F.xxhash64(*ROW).alias("h")).groupBy("h").count().where("count > 1").isEmpty()

    @staticmethod
    def _tile(at: str | Column) -> Column:
        return F.floor((F.col(at) if isinstance(at, str) else at) / TILE).cast("long")

    def parted(self, rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """(rows that tiles can serve, those that go by their pairs, None if there is none).

        By their pairs go rows whose key recurs, that are empty, or that meet one of several matches of a pair.
        """
        tests = [~F.coalesce(F.col("s") < F.col("e"), F.lit(False))] if self.odd else []
        if self.any_twice:
            rows = rows.withColumn("__same", F.count("*").over(Window.partitionBy(*ROW)))
            tests.append(F.col("__same") > 1)
        if self.any_several:
            meets = candidate_pairs(rows.select(*ROW, "chrom", "s", "e"), self.several.drop("kind", "several")).select(*ROW).distinct()
            rows = rows.join(meets.withColumn("__meets", F.lit(True)), ROW, "left")
            tests.append(F.col("__meets").isNotNull())
        if not tests:
            return rows, None
        rows = rows.withColumn("__pairs", reduce(Column.__or__, tests))
        return rows.where("not __pairs").drop("__pairs", "__same", "__meets"), rows.where("__pairs").drop("__pairs", "__same", "__meets")

    def _stream(self, rows: DataFrame, keep: list[str], corr: bool) -> DataFrame:
        """Matches and alignments of each slice together, the matches first."""
        mask = reduce(Column.bitwiseOR, [F.when(passes_for(k), F.lit(1 << i if i < 63 else -(1 << 63)).cast("long")).otherwise(F.lit(0).cast("long")) for i, k in enumerate(self.kinds)])
        hot = lambda df: df.join(F.broadcast(self.hot), (F.col("chrom") == F.col("__c")) & (F.col("__tile") == F.col("__t")), "left").drop("__c", "__t")
        salt = F.coalesce(F.pmod(F.xxhash64("name", "s", "e", *(["row_key"] if "row_key" in keep else [])), F.col("__slices")).cast("int"), F.lit(0))
        left = hot(rows.withColumn("__tile", self._tile("s")))
        share = [F.col("corr").alias("__corr")] if corr else []
        left = left.select("chrom", "__tile", salt.alias("__salt"), F.lit(1).alias("__side"), F.lit(0).alias("__kind"), F.col("s").cast("long").alias("__from"), F.col("e").cast("long").alias("__to"),
            mask.alias("__mask"), F.coalesce("fwd", F.lit(False)).cast("int").alias("__fwd"), *[F.lit(None).cast("string").alias(c) for c in PAIR], *share, *keep)
        tiles = F.explode(F.sequence(self._tile(F.col("fs") - (self.longest - 1)), self._tile(F.col("fe") - 1)))
        right = hot(self.single.withColumn("__tile", tiles))
        empty = [F.lit(None).cast(left.schema[c].dataType).alias(c) for c in left.columns[len(PAIR) + 9 :]]
        right = right.select("chrom", "__tile", F.explode(F.sequence(F.lit(0), F.coalesce("__slices", F.lit(1)) - 1)).alias("__salt"), F.lit(0).alias("__side"), "kind", "fs", "fe",
            F.lit(0).cast("long").alias("__mask"), F.lit(0).alias("__fwd"), *PAIR, *empty)
        return right.toDF(*left.columns).union(left).repartition(*_SLOT).sortWithinPartitions(*_SLOT, "__side")

    def shares(self, rows: DataFrame, norm_hits: bool) -> DataFrame:
        """(library, feature_id, classifier, rule_idx, count) of rows with corr, several rows for a pair."""
        schema = "library string, feature_id string, classifier string, rule_idx int, count double"
        return self._stream(rows, ["library"], True).mapInArrow(_summed(self.kinds, norm_hits), schema)

    def named(self, rows: DataFrame, keep: list[str]) -> DataFrame:
        """The rows' columns ``keep`` with hits, feature (null if there is none or there are several) and several."""
        stream = self._stream(rows, keep, False)
        schema = ", ".join(f"{c} {stream.schema[c].dataType.simpleString()}" for c in keep)
        return stream.mapInArrow(_named(self.kinds, keep), f"{schema}, hits long, feature string, several boolean")


def shares(alignments: DataFrame, matches: DataFrame, norm_loci: bool = True, norm_hits: bool = True, rules: DataFrame | None = None) -> DataFrame:
    """(library, feature_id, classifier, rule_idx, fcorr, n_rules): the sums of ``assign``'s shares, in the form of its rows."""
    tiled, by = Tiled(alignments, matches, rules), ["library", *PAIR, "rule_idx"]
    summed = lambda assigned: assigned.groupBy(*by).agg(F.sum(F.col("fcorr") / F.col("n_rules")).alias("count"))
    if not tiled.usable:
        return summed(assign(alignments, matches, norm_loci, norm_hits))
    rows, paired = tiled.parted(with_loci(alignments, norm_loci))
    found = tiled.shares(rows, norm_hits)
    if paired is not None:
        found = found.union(summed(with_hits(choose(candidate_pairs(paired, tiled.matches)), norm_hits)))
    # what the sums' binary places cut off is rounded away
    return found.groupBy(*by).agg(F.round(F.sum("count"), 12).alias("fcorr")).withColumn("n_rules", F.lit(1))


def reads(alignments: DataFrame, matches: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """(library, name): loci, read_count, assigned, unassigned, n_features (2: several), first alignment's nt5 and length."""
    tiled, keep = Tiled(alignments, matches, rules), [*ROW, "read_count", "nt5", "length"]
    per_row = lambda assigned: assigned.groupBy(*ROW).agg(F.max("hits").cast("long").alias("hits"), F.min("feature_id").alias("feature"), (F.min("feature_id") != F.max("feature_id")).alias("several"))
    of = lambda rows: rows.select(*keep).join(per_row(assign(rows, tiled.matches)), ROW, "left")
    if not tiled.usable:
        found = of(alignments)
    else:
        rows, paired = tiled.parted(alignments)
        found = tiled.named(rows, keep)
        if paired is not None:
            found = found.unionByName(of(paired))
    some = F.coalesce("hits", F.lit(0)) > 0
    several = F.coalesce(F.max("several"), F.lit(False)) | (F.min("feature") != F.max("feature"))
    n_features = F.when(several, 2).when(F.max("feature").isNotNull(), 1).otherwise(0)
    first = F.min_by(F.struct("nt5", "length"), F.col("row_key"))
    value = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("read_count"))), F.lit(0)).cast("double") / F.count("*")
    return found.groupBy("library", "name").agg(
        F.count("*").alias("loci"), F.first("read_count").alias("read_count"), value(some).alias("assigned"), value(~some).alias("unassigned"), n_features.alias("n_features"), first.alias("f"),
    ).select("*", "f.nt5", "f.length").drop("f")
