"""Analyses of catalogs and archives: agreement, id gaps, field profiles, daily field diffs, attestations and overlays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import discard, stored
from .compare import align, field_diff


def agreement(archives: DataFrame) -> DataFrame:
    """(date, archives, hashes, common_sha256, agreeing, agreed) of independent archives' (archive, date, sha256, object_count).

    Of equally common hashes the smallest counts; agreeing archives have it, and agreed means that all do with one count.
    """
    each = archives.groupBy("date", "sha256").agg(F.count("*").alias("n"), F.count_distinct("object_count").alias("counts"))
    days = each.groupBy("date").agg(F.sum("n").alias("archives"), F.count("*").alias("hashes"), F.min(F.struct(-F.col("n"), "sha256")).alias("top"), F.max("counts").alias("counts"))
    return days.select("date", "archives", "hashes", F.col("top.sha256").alias("common_sha256"), (-F.col("top.col1")).alias("agreeing"), ((F.col("hashes") == 1) & (F.col("counts") == 1)).alias("agreed"))


def gap_summaries(ids: DataFrame, id_col: str, by: tuple[str, ...] = (), bucket: int = 65_536) -> DataFrame:
    """(by, b, present, lo, hi, gap) of each group's buckets of so many ids: how many there are, the least, the largest, and the largest gap inside as (size, -from, to).

    A bucket has at most `bucket` distinct ids, so no window is larger; repeats are dropped before it.
    """
    one = ids.where(F.col(id_col).isNotNull()).select(*by, F.col(id_col).cast("long").alias("i")).distinct().withColumn("b", F.floor(F.col("i") / bucket).cast("long"))
    nexts = one.withColumn("n", F.lead("i").over(Window.partitionBy(*by, "b").orderBy("i")))
    gap = F.when(F.col("n") > F.col("i") + 1, F.struct((F.col("n") - F.col("i") - 1).alias("size"), (-F.col("i")).alias("from"), F.col("n").alias("to")))
    return nexts.groupBy(*by, "b").agg(F.count("*").alias("present"), F.min("i").alias("lo"), F.max("i").alias("hi"), F.max(gap).alias("gap"))


def merged_gaps(summaries: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, present, lowest, highest, g) of buckets' summaries, joined at their edges: one row a bucket takes part, for all groups at once."""
    ends = summaries.withColumn("next", F.lead("lo").over(Window.partitionBy(*by).orderBy("b")))
    between = F.when(F.col("next") > F.col("hi") + 1, F.struct((F.col("next") - F.col("hi") - 1).alias("size"), (-F.col("hi")).alias("from"), F.col("next").alias("to")))
    return ends.groupBy(*by).agg(F.sum("present").alias("present"), F.min("lo").alias("lowest"), F.max("hi").alias("highest"), F.max(F.greatest("gap", between)).alias("g"))


def id_gaps(ids: DataFrame, id_col: str, bucket: int = 1_000_000) -> DataFrame:
    """(present, lowest, highest, span, missing, density, largest_gap, gap_from, gap_to) of a set of integer ids; of equal gaps the lowest."""
    whole = merged_gaps(gap_summaries(ids, id_col, (), bucket))
    span = F.col("highest") - F.col("lowest") + 1
    return whole.select("present", "lowest", "highest", span.alias("span"), (span - F.col("present")).alias("missing"), F.round(F.col("present") / span, 6).alias("density"), F.coalesce("g.size", F.lit(0)).cast("long").alias("largest_gap"), (1 - F.col("g.from")).alias("gap_from"), (F.col("g.to") - 1).alias("gap_to"))


def id_gap_changes(states: DataFrame, id_col: str, date_col: str = "snapshot_date", bucket: int = 65_536) -> DataFrame:
    """(date, present, missing, largest_gap, present_change, missing_change, gap_change) of each day's ids, changes against the day before in the table; null on the first.

    Days are summed up in buckets of ids, so that neither a day's ids nor those of a range meet in one task.
    """
    whole = merged_gaps(gap_summaries(states, id_col, (date_col,), bucket), (date_col,))
    days = whole.select(date_col, "present", (F.col("highest") - F.col("lowest") + 1 - F.col("present")).alias("missing"), F.coalesce("g.size", F.lit(0).cast("long")).alias("largest_gap"))
    before = Window.orderBy(date_col)  # one row for each day
    change = lambda c: F.col(c) - F.lag(c).over(before)
    return days.select(date_col, "present", "missing", "largest_gap", change("present").alias("present_change"), change("missing").alias("missing_change"), change("largest_gap").alias("gap_change"))


def field_profile(records: DataFrame, record_col: str = "rec") -> DataFrame:
    """(field, records, blanks, distinct, smallest, largest, constant) of every key of record maps; null and '' are blank."""
    fields = records.select(F.explode(record_col).alias("field", "value"))
    full = F.when(F.col("value") != "", F.col("value"))
    found = fields.groupBy("field").agg(F.count("*").alias("records"), F.count_if(full.isNull()).alias("blanks"), F.count_distinct(full).alias("distinct"), F.min(full).alias("smallest"), F.max(full).alias("largest"))
    return found.withColumn("constant", F.col("distinct") <= 1)


def value_summaries(records: DataFrame, kept: int, record_col: str = "rec") -> DataFrame:
    """(field, value, low, lost): each task's most frequent values of each field, `kept` of them at most, with counts that are too low by no more than `lost`.

    A task that holds more values takes the count of the first one beyond those kept off all of them, and forgets what falls to zero: no value that it forgets had
    more than `lost` records there, which stands once for each field, with a null value.
    """

    def run(batches):
        import pyarrow as pa

        held: dict[str, dict[str, int]] = {}
        lost: dict[str, int] = {}
        for batch in batches:
            counts = pa.table([batch.column(0), batch.column(1)], names=["f", "v"]).group_by(["f", "v"]).aggregate([([], "count_all")])
            for field, value, n in zip(*[counts.column(k).to_pylist() for k in ("f", "v", "count_all")]):
                mine = held.setdefault(field, {})
                mine[value] = mine.get(value, 0) + n
            for field, mine in held.items():
                if len(mine) > 2 * kept:
                    off = sorted(mine.values(), reverse=True)[kept]
                    held[field] = {v: n - off for v, n in mine.items() if n > off}
                    lost[field] = lost.get(field, 0) + off
        rows = [(f, v, n, 0) for f, mine in held.items() for v, n in mine.items()] + [(f, None, 0, n) for f, n in lost.items()]
        for at in range(0, len(rows), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[at : at + 10_000]), (pa.string(), pa.string(), pa.int64(), pa.int64()))], names=["field", "value", "low", "lost"])

    fields = records.select(F.explode(record_col).alias("field", "value")).where("value is not null")
    return fields.mapInArrow(run, "field string, value string, low long, lost long")


def top_values(records: DataFrame, n: int, record_col: str = "rec", kept: int = 10_000) -> DataFrame:
    """(field, rank, value, count): the n most frequent values of each field, ties by value: a report.

    Tasks sum up their most frequent values in bounded memory (value_summaries). Values whose count could reach the n-th one are then counted exactly, and the report
    stands if no other value can have as many: if the records that the tasks may have lost of it are fewer than the n-th exact count. Fields for which that
    doesn't hold, whose values are nearly equally frequent, are counted in full.
    """
    sums = stored(value_summaries(records, kept, record_col).groupBy("field", "value").agg(F.sum("low").alias("low"), F.sum("lost").alias("lost")), "values")
    lost = sums.groupBy("field").agg(F.sum("lost").alias("off"))
    ranked = sums.where("value is not null").withColumn("r", F.expr("row_number() over (partition by field order by low desc)")).where(F.col("r") <= n)
    least = ranked.groupBy("field").agg(F.min("low").alias("bar"), F.max("r").alias("there"))
    bounds = lost.join(least, "field", "left").withColumn("bar", F.when(F.col("there") == n, F.col("bar")).otherwise(0))
    near = sums.where("value is not null").join(bounds, "field").where("low + off >= bar").select("field", "value")
    fields = records.select(F.explode(record_col).alias("field", "value")).where("value is not null")
    exact = stored(fields.join(near, ["field", "value"], "left_semi").groupBy("field", "value").agg(F.count("*").alias("count")), "counts")
    rank = F.expr("row_number() over (partition by field order by count desc, value)")
    best = exact.withColumn("rank", rank).where(F.col("rank") <= n)
    last = best.groupBy("field").agg(F.min("count").alias("last"), F.count("*").alias("there"))
    # nothing lost: every value has been counted
    unproven = lost.join(last, "field", "left").where((F.col("off") > 0) & ((F.coalesce("there", F.lit(0)) < n) | (F.col("off") >= F.col("last")))).select("field")
    unproven = stored(unproven, "unproven")
    if unproven.isEmpty():
        return best.select("field", "rank", "value", "count")
    full = fields.join(F.broadcast(unproven), "field", "left_semi").groupBy("field", "value").agg(F.count("*").alias("count")).withColumn("rank", rank).where(F.col("rank") <= n)
    return best.join(F.broadcast(unproven), "field", "left_anti").unionByName(full).select("field", "rank", "value", "count")


def key_sets(records: DataFrame, record_col: str = "rec") -> DataFrame:
    """(keys, records): the distinct sets of keys."""
    return records.groupBy(F.array_sort(F.map_keys(record_col)).alias("keys")).agg(F.count("*").alias("records"))


def daily_diff(before: DataFrame, after: DataFrame, id_col: str = "object_id", record_col: str = "rec") -> DataFrame:
    """Every differing field of objects that two consecutive snapshots hold with different records."""
    return field_diff(align(before, after, id_col, record_col), id_col, shown=1 << 30)


def scored_attestations(attestations: DataFrame, scores: DataFrame) -> DataFrame:
    """attestations (chain, ref, block, attester, block_time, ...) with the attester's last score at or before the block's time, else 0.

    Scores (attester, score_time, score) and attestations are merged in time order per attester, so there is no range join.
    """
    a = attestations.withColumn("_t", F.col("block_time")).withColumn("_k", F.lit(1)).withColumn("score", F.lit(None).cast("double"))
    s = scores.select("attester", F.col("score_time").alias("_t"), F.lit(0).alias("_k"), F.col("score").cast("double"))
    both = a.unionByName(s, allowMissingColumns=True)
    last = F.expr("last(score, true) over (partition by attester order by _t, _k rows between unbounded preceding and current row)")
    return both.withColumn("score", F.coalesce(last, F.lit(0.0))).where("_k = 1").drop("_t", "_k")


#: Blocks from which on ancestors are doubled at once instead of contracting paths first.
FEW_BLOCKS = 1_000_000


def _best(weight: Column, tip: Column, length: Column) -> Column:
    """A branch as a value of which the smallest is the heaviest, of equal ones that with the smaller tip."""
    return F.struct((-weight).alias("less"), tip.alias("tip"), length.alias("n"))


def _below(best: Column, weight: Column, length: Column) -> Column:
    """A branch that begins so much further up; null stays null."""
    return F.when(best.isNotNull(), F.struct((best["less"] - weight).alias("less"), best["tip"].alias("tip"), (best["n"] + length).alias("n")))


def contracted(walk: DataFrame, number: int) -> DataFrame:
    """Fewer rows (chain, block, up, weight, length, best) with the same heaviest branches, after one round.

    A row is a stretch of a path, whose children hang at its end; best is the heaviest branch known from its start on, null if none is. A row without children goes into
    its parent's best. A row with one child may go into that child, by a coin of their names, so that of two in a row only one goes; a row that takes its parent in stays.
    """
    coin = lambda c: F.pmod(F.xxhash64("chain", c, F.lit(number)), F.lit(2))
    kids = walk.where("up is not null").groupBy("chain", F.col("up").alias("block")).agg(F.count("*").alias("kids"), F.min("block").alias("only"))
    here = walk.join(kids, ["chain", "block"], "left").withColumn("goes", F.coalesce((F.col("kids") == 1) & (coin("block") == 1) & (coin("only") == 0), F.lit(False)))
    here = here.withColumn("best", F.coalesce("best", F.when(F.col("kids").isNull(), _best(F.col("weight"), F.col("block"), F.col("length")))))
    tops = here.where("goes").select("chain", F.col("only").alias("block"), F.struct("up", "weight", "length", "best").alias("top"))
    here = here.where("not goes").join(tops, ["chain", "block"], "left")
    ends = F.col("kids").isNull() & F.col("top").isNull() & F.col("up").isNotNull()
    ended = here.where(ends).groupBy("chain", F.col("up").alias("block")).agg(F.min("best").alias("ended"))
    stay = here.where(~ends).join(ended, ["chain", "block"], "left")
    best = F.least("best", _below(F.col("ended"), F.col("weight"), F.col("length")))
    best = F.when(F.col("top").isNull(), best).otherwise(F.least(_below(best, F.col("top.weight"), F.col("top.length")), F.col("top.best")))
    more = lambda c: F.col(c) + F.coalesce(f"top.{c}", F.lit(0).cast("int"))
    return stay.select("chain", "block", F.when(F.col("top").isNull(), F.col("up")).otherwise(F.col("top.up")).alias("up"), more("weight").alias("weight"), more("length").alias("length"), best.alias("best"))


def heaviest_branch(blocks: DataFrame, scored: DataFrame) -> DataFrame:
    """(chain, tip, weight, length): for each chain the tip whose path to the root gathers most weight, ties to the smaller tip.

    blocks: (chain, block, parent), parent null at a root; one that is not a block ends its path too. A block's weight is the sum of its
    attesters' scores. Branches that end are taken into their parents and paths are contracted, so that a round has a fraction of the blocks of the one before and all of them
    together a few times the blocks; what is left doubles the ancestors that a block's sum covers, in rounds that grow with the logarithm of a path's length. Blocks with
    two parents count by each of them and aren't contracted. Raises ValueError at a cycle.
    """
    weights = scored.groupBy("chain", "block").agg(F.sum("score").alias("w"))

    def start(own: DataFrame) -> DataFrame:
        names = own.select("chain", F.col("block").alias("parent"), F.lit(True).alias("_known")).distinct()
        own = own.join(weights, ["chain", "block"], "left").join(names, ["chain", "parent"], "left")
        return own.select("chain", "block", F.when(F.col("_known"), F.col("parent")).alias("up"), F.coalesce("w", F.lit(0.0)).alias("weight"), F.lit(1).alias("length"))

    least = blocks.groupBy("chain", "block").agg(F.min("parent").alias("parent"), F.max("parent").alias("_most"), F.count("parent").alias("_some"), F.count("*").alias("_all"))
    least = stored(least, "blocks")
    single = least.where("parent <> _most or (_some > 0 and _some < _all)").isEmpty()
    own = least.select("chain", "block", "parent") if single else blocks.select("chain", "block", "parent").distinct()
    none = F.lit(None).cast(f"struct<less:double,tip:{own.schema['block'].dataType.simpleString()},n:int>")
    walk = stored(start(own).withColumn("best", none), "walk")
    n, number = walk.count(), 0
    while single and n > FEW_BLOCKS:
        before, walk = walk, stored(contracted(walk, number), "walk")
        discard(before)
        number, last, n = number + 1, n, walk.count()
        if n > last * 0.95:  # blocks in circles don't get fewer
            break
    rest, walk = walk, walk.drop("best")
    for _ in range(n.bit_length() + 1):
        if walk.where("up is not null").isEmpty():
            break
        over = walk.select("chain", F.col("block").alias("up"), F.col("up").alias("_up"), F.col("weight").alias("_weight"), F.col("length").alias("_length"))
        walk = stored(walk.join(over, ["chain", "up"], "left").select("chain", "block", F.col("_up").alias("up"), (F.col("weight") + F.coalesce("_weight", F.lit(0.0))).alias("weight"), (F.col("length") + F.coalesce("_length", F.lit(0))).alias("length")), "walk")
    else:
        raise ValueError("blocks are their own ancestors")
    # branches within a row go on above it; a row that nothing hangs at ends at itself
    above = walk.select("chain", F.col("block").alias("up"), F.col("weight").alias("_weight"), F.col("length").alias("_length"))
    within = rest.where("best is not null").join(above, ["chain", "up"], "left")
    within = within.select("chain", _below(F.col("best"), F.coalesce("_weight", F.lit(0.0)), F.coalesce("_length", F.lit(0))).alias("b"))
    tips = walk.join(rest.select("chain", F.col("up").alias("block")).where("block is not null").distinct(), ["chain", "block"], "left_anti")
    tips = tips.join(rest.where("best is not null").select("chain", "block"), ["chain", "block"], "left_anti").select("chain", _best(F.col("weight"), F.col("block"), F.col("length")).alias("b"))
    found = within.unionByName(tips).groupBy("chain").agg(F.min("b").alias("b"))
    return found.select("chain", "b.tip", (-F.col("b.less")).alias("weight"), F.col("b.n").alias("length"))


def within_quota(uses: DataFrame, quotas: DataFrame, cap: int) -> DataFrame:
    """uses (signer, chain, at) with `allowed`: the first min(holdings, cap) of a signer, chain and UTC day, if its score is above 0. quotas: (signer, holdings, score)."""
    limit = F.when(F.col("score") > 0, F.least("holdings", F.lit(cap))).otherwise(0)
    ranked = uses.withColumn("_r", F.expr("row_number() over (partition by signer, chain, cast(at as date) order by at)"))
    return ranked.join(quotas, "signer", "left").withColumn("allowed", F.coalesce(F.col("_r") <= limit, F.lit(False))).select(*uses.columns, "allowed")


def hourly_budget(uses: DataFrame, budget: float) -> DataFrame:
    """uses (signer, at, cost) with the spend of the hour up to each and whether it is within the budget.

    A signer's uses go by hours: each is in its own hour and, for what comes after, in the next, so no group holds more than two hours of a signer. A group is summed
    up twice as it is sorted: its own uses from the first on, those of the hour before from the last down, moved on by an hour. So a use costs the same however many
    stand in its hour, and nothing is subtracted. Uses without a time are summed up with each other.
    """
    hour = F.unix_timestamp(F.date_trunc("hour", F.col("at").cast("timestamp"))) / 3600
    both = uses.withColumn("_hour", hour.cast("long")).withColumn("_own", F.explode(F.array(F.lit(True), F.lit(False)))).where("_own or _hour is not null")
    both = both.withColumn("_hour", F.col("_hour") + F.when(F.col("_own"), 0).otherwise(1)).withColumn("_at", F.expr("if(_own, at, at + interval 1 hour)"))
    here = F.expr("sum(if(_own, cost, null)) over (partition by signer, _hour order by _at range between unbounded preceding and current row)")
    before = F.expr("sum(if(_own, null, cost)) over (partition by signer, _hour order by _at desc range between unbounded preceding and current row)")
    found = both.withColumn("_here", here).withColumn("_before", before).where("_own")
    spent = F.coalesce(F.col("_here") + F.col("_before"), "_here", "_before")
    return found.withColumn("spent", spent).drop("_own", "_hour", "_at", "_here", "_before").withColumn("within", F.col("spent") <= budget)


def overlay(index: DataFrame, events: DataFrame, key: str, latest_indexed: int, block_col: str = "block", window_from: int | None = None) -> DataFrame:
    """The static index with events after its last block laid over it; stale if the events' window begins after that block."""
    fresh = events.where(F.col(block_col) > latest_indexed)
    last = fresh.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(block_col)))).where("_r = 1").drop("_r")
    stale = window_from is not None and window_from > latest_indexed + 1
    kept = index.join(last.select(key), key, "left_anti")
    return kept.unionByName(last, allowMissingColumns=True).withColumn("stale", F.lit(stale))
