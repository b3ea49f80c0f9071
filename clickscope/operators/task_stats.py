"""SRC-5 / SRC-6 for many tasks at once: the session statistics (AGG-2, AGG-3) of every row of a task table in one pass over
the actions, instead of one job per task.

1. Actions become one row per (session, day) with mergeable measures (times, count, user): the only pass over the facts.
2. A session whose days in the data are one day has the same measures in every task that covers the day. A session over several
   days is cut differently by every date range, so its day rows are merged per (distinct range of the tasks, session).
3. Tasks with keywords or categories (FLT-2 on list fields) need to know which sessions hold one inside the range: a session's
   *marks* are the values it holds that any task asks for, and an *ask* is a distinct pair of lists. Sets of marks meet asks, not
   sessions tasks.
4. Sessions are counted per (day or range, user traits, ask), and these counts are rolled up: a trait also to "any", days and ages
   also to blocks of 2, 4, 8, … neighbours.
5. A task is a few equi-join keys of these counts (the blocks that make up its days and ages, its professions, its cities), so
   the work grows with sessions plus tasks, not with their product.

Every task has a row; one without sessions has a count of 0 and null ratios. Parameters follow :mod:`clickscope.params`: missing,
empty or malformed ones are unset; without a start or end date the range is open. A null task id is a task like others; of equal
rows of the task table each counts (and a list task merges their steps).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import materialize
from ..functions import buckets, dates
from ..functions.numbers import ratio_half_up
from ..params import task_params_table

TRAITS = ["age", "professional", "city", "sex"]
NAMED = ["professional", "city", "sex"]
PERIOD = ["period", "of"]  # level and number of a block of days, or -1 - first day and last day of a range
KEYS = ["ask", *PERIOD, "age_level", "age_block", *NAMED]
ANY = ""


def _session() -> Column:
    """Key of a session; rows without session id form one session."""
    return F.when(F.col("session_id").isNull(), "n").otherwise(F.concat(F.lit("s"), F.col("session_id"))).alias("session")


def session_days(actions: DataFrame) -> DataFrame:
    """One row per (session, day): ``session, day, user_id, first, last, steps``."""
    return actions.groupBy(_session(), F.to_date("date").alias("day")).agg(
        F.min("user_id").alias("user_id"), F.min("action_time").alias("first"), F.max("action_time").alias("last"),
        F.count(F.lit(1)).alias("steps"))


def _bucket(c: Column, table) -> Column:
    """Number of the bucket that holds ``c``; null when none does."""
    out = F.lit(None).cast("int")
    for i, (_, lo, hi) in reversed(list(enumerate(table))):
        out = F.when(buckets.in_bucket(c, lo, hi), F.lit(i)).otherwise(out)
    return out


def _list(c: str) -> Column:
    return F.filter(F.split(F.col(c), ","), lambda x: x != "")


def typed_tasks(tasks: DataFrame) -> DataFrame:
    """The parameters that the session statistics use, typed, with a key that also tells null ids apart."""
    p = task_params_table(tasks)
    day = lambda c: F.try_to_timestamp(F.col(c), F.lit("yyyy-MM-dd")).cast("date")
    return p.select("task_id", F.coalesce(F.col("task_id").cast("string"), F.lit("")).alias("task"),
                    day("startDate").alias("start"), day("endDate").alias("end"),
                    F.col("startAge").try_cast("int").alias("age_from"), F.col("endAge").try_cast("int").alias("age_to"),
                    _list("professionals").alias("professionals"), _list("cities").alias("cities"),
                    F.col("sex").alias("wanted_sex"), _list("keywords").alias("keywords"),
                    F.transform(_list("categoryIds"), lambda x: x.try_cast("bigint")).alias("categories"))


def _blocks_of(c: Column, levels: int) -> Column:
    """The blocks of 1, 2, 4, … neighbouring numbers that hold ``c`` (from 0): ``level, block``."""
    return F.array(*[F.struct(F.lit(j).alias("level"), F.shiftright(c, j).alias("block")) for j in range(levels + 1)])


def _blocks_between(a: Column, b: Column, levels: int) -> Column:
    """Disjoint blocks that hold the numbers from ``a`` to ``b`` and no others: at most two per level, none if ``a > b``."""
    out = []
    for j in range(levels + 1):
        lo, hi = F.shiftright(a + F.lit((1 << j) - 1), j), F.shiftright(b + F.lit(1), j)
        block = lambda x, j=j: F.struct(F.lit(j).alias("level"), x.alias("block"))
        out += [F.when((lo < hi) & (lo % 2 == 1), block(lo)), F.when((lo < hi) & (hi % 2 == 1), block(hi - 1))]
    return F.filter(F.array(*out), lambda x: x.isNotNull())


def _ask(copies: Column) -> Column:
    """Key of a task's list parameters; ``copies`` of its row multiply the steps."""
    lists = [F.sort_array(F.array_distinct(F.col(c))).alias(c) for c in ("keywords", "categories")]
    return F.to_json(F.struct(*lists, copies.cast("bigint").alias("copies")))


def _marks(kind: str, c) -> Column:
    return F.concat(F.lit(kind), c.cast("string"))


def _ask_marks(asks: DataFrame) -> DataFrame:
    """``ask, mark, kind`` of every value of the asks' lists."""
    def of(column, kind):
        return asks.select("ask", F.explode(column).alias("v")).where("v IS NOT NULL").select(
            "ask", _marks(kind, F.col("v")).alias("mark"), F.lit(kind).alias("kind"))
    return of("keywords", "k").unionByName(of("categories", "c")).distinct()


def _marks_held(actions: DataFrame, asked: DataFrame) -> DataFrame:
    """Per (session, day) the sorted marks of which some ask names one: ``session, day, marks``."""
    day = F.to_date("date").alias("day")
    of = lambda column, kind: actions.where(F.col(column).isNotNull()).select(
        _session(), day, _marks(kind, F.col(column)).alias("mark"))
    held = of("search_keyword", "k").unionByName(of("click_category_id", "c"))
    return (held.join(asked.select("mark").distinct(), "mark", "left_semi")
            .groupBy("session", "day").agg(F.sort_array(F.collect_set("mark")).alias("marks")))


def _met(cells: DataFrame, asks: DataFrame, asked: DataFrame) -> DataFrame:
    """``marks, ask, copies``: the asks that a set of marks meets, one of each list that the ask has."""
    sets = cells.where(F.size("marks") > 0).select("marks").distinct()
    has = (sets.select("marks", F.explode("marks").alias("mark")).join(asked, "mark")
           .groupBy("marks", "ask").agg(F.bool_or(F.col("kind") == "k").alias("has_keyword"),
                                        F.bool_or(F.col("kind") == "c").alias("has_category")))
    return has.join(asks, "ask").where((F.col("keywords").isNull() | F.col("has_keyword"))
                                       & (F.col("categories").isNull() | F.col("has_category"))).select("marks", "ask", "copies")


def _or_any(c: Column) -> Column:
    """Keys that a trait's value is counted under."""
    own = F.concat(F.lit("="), c)
    return F.when(own.isNull(), F.array(F.lit(ANY))).otherwise(F.array(F.lit(ANY), own))


def _wanted(c: str) -> Column:
    """Keys that a list parameter asks for."""
    return F.when(F.col(c).isNull(), F.array(F.lit(ANY))).otherwise(
        F.transform(F.array_distinct(F.col(c)), lambda x: F.concat(F.lit("="), x)))


def task_session_stats(actions: DataFrame, users: DataFrame, tasks: DataFrame, visit_buckets=buckets.VISIT_BUCKETS,
                       step_buckets=buckets.STEP_BUCKETS) -> DataFrame:
    """Per task: ``task_id, session_count`` and the share of sessions per visit and step bucket (as
    :func:`clickscope.operators.sessions.session_stats`). ``tasks`` has ``task_id, task_param``."""
    days = materialize(session_days(actions))  # slim rows that several branches read
    traits = users.select("user_id", *TRAITS)
    # one row with the ends of the days and ages goes to the driver
    low, high = days.agg(F.min("day"), F.max("day")).first()
    young, old = traits.agg(F.min("age"), F.max("age")).first()
    first_day, last_day = (F.lit(x).cast("date") for x in (low, high))
    day_levels = (high - low).days.bit_length() if low is not None else 0
    age_levels = (old - young).bit_length() if young is not None else 0
    day_no = lambda c: F.datediff(c, first_day).cast("bigint")
    age_no = lambda c: F.col(c).cast("bigint") - F.lit(young or 0).cast("bigint")

    typed = typed_tasks(tasks)
    copies = typed.groupBy("task").agg(F.count(F.lit(1)).alias("copies"))
    lists = F.col("keywords").isNotNull() | F.col("categories").isNotNull()
    ranged = (typed.drop("task_id").join(copies, "task")
              .withColumn("a", day_no(F.greatest(F.coalesce("start", first_day), first_day)))
              .withColumn("b", day_no(F.least(F.coalesce("end", last_day), last_day))).where("a <= b")
              .withColumn("day_ask", _ask(F.when(lists, F.col("copies")).otherwise(1))).withColumn("range_ask", _ask(F.col("copies"))))
    ranged = materialize(ranged)
    ask_of = lambda name, n: ranged.select(F.col(name).alias("ask"), "keywords", "categories", n.alias("copies"))
    asks = (ask_of("day_ask", F.when(lists, F.col("copies")).otherwise(1).cast("bigint"))
            .unionByName(ask_of("range_ask", F.col("copies"))).dropDuplicates(["ask"]))
    asked = _ask_marks(asks)

    # sessions of one day, and those of several days merged per range
    spread = days.groupBy("session").agg(F.count(F.lit(1)).alias("n_days"))
    marked = days.where("day IS NOT NULL").join(spread, "session").join(_marks_held(actions, asked), ["session", "day"], "left")
    one = marked.where("n_days = 1").select(F.lit(0).cast("bigint").alias("period"), day_no(F.col("day")).alias("of"), "user_id",
                                            "first", "last", "steps", "marks")
    ranges = ranged.select("a", "b").distinct().select("a", "b", F.explode(F.sequence("a", "b")).alias("no"))
    several = (marked.where("n_days > 1").withColumn("no", day_no(F.col("day"))).join(ranges, "no").groupBy("a", "b", "session")
               .agg(F.min("user_id").alias("user_id"), F.min("first").alias("first"), F.max("last").alias("last"),
                    F.sum("steps").alias("steps"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("marks")))).alias("marks"))
               .select((-1 - F.col("a")).alias("period"), F.col("b").alias("of"), "user_id", "first", "last", "steps", "marks"))

    # counts per (day or range, traits, marks, copies), then per ask
    v = _bucket(dates.seconds_between(F.col("last"), F.col("first")), visit_buckets)
    s = _bucket(F.col("steps") * F.col("copies"), step_buckets)
    names = ([("_v", i, "visit_" + b[0]) for i, b in enumerate(visit_buckets)]
             + [("_s", i, "step_" + b[0]) for i, b in enumerate(step_buckets)])
    measures = ["_n", *[n for _, _, n in names]]
    share = lambda c, i, name: F.sum(F.when(F.col(c) == i, 1).otherwise(0)).alias(name)
    added = [F.sum(m).alias(m) for m in measures]
    cells = materialize(
        one.unionByName(several).join(traits, "user_id").crossJoin(F.broadcast(asks.select("copies").distinct()))
        .withColumns({"_v": v, "_s": s, "marks": F.coalesce("marks", F.array().cast("array<string>"))})
        .groupBy(*PERIOD, *TRAITS, "marks", "copies")
        .agg(F.count(F.lit(1)).alias("_n"), *[share(c, i, n) for c, i, n in names]))
    plain = cells.groupBy(*PERIOD, *TRAITS, "copies").agg(*added).join(asks.where(~lists).select("ask", "copies"), "copies")
    listed = cells.join(_met(cells, asks, asked), ["marks", "copies"])
    cols = ["ask", *PERIOD, *TRAITS, *measures]
    per_ask = plain.select(*cols).unionByName(listed.select(*cols))

    # rolled up: blocks of days and ages first, then every trait also as any
    any_age = F.array(F.struct(F.lit(-1).alias("level"), F.lit(0).cast("bigint").alias("block")))
    aged = F.when(F.col("age").isNull(), any_age).otherwise(F.concat(any_age, _blocks_of(age_no("age"), age_levels)))
    in_days = F.transform(_blocks_of(F.col("of"), day_levels),
                          lambda x: F.struct(x["level"].cast("bigint").alias("period"), x["block"].alias("of")))
    periods = F.when(F.col("period") < 0, F.array(F.struct("period", "of"))).otherwise(in_days)
    rolled = per_ask.withColumn("_p", F.explode(periods)).withColumn("_a", F.explode(aged)).select(
        "ask", F.col("_p.period").alias("period"), F.col("_p.of").alias("of"), F.col("_a.level").alias("age_level"),
        F.col("_a.block").alias("age_block"), *NAMED, *measures).groupBy(*KEYS).agg(*added)
    for c in NAMED:
        rolled = rolled.withColumn(c, F.explode(_or_any(F.col(c))))
    rolled = rolled.groupBy(*KEYS).agg(*added)

    # the keys of a task
    no_age = F.col("age_from").isNull() | F.col("age_to").isNull()
    ages = _blocks_between(F.greatest(age_no("age_from"), F.lit(0).cast("bigint")),
                           F.least(age_no("age_to"), F.lit((old or 0) - (young or 0)).cast("bigint")), age_levels)
    covered = F.transform(_blocks_between(F.col("a"), F.col("b"), day_levels), lambda x: F.struct(
        F.col("day_ask").alias("ask"), x["level"].cast("bigint").alias("period"), x["block"].alias("of")))
    whole = F.array(F.struct(F.col("range_ask").alias("ask"), (-1 - F.col("a")).alias("period"), F.col("b").alias("of")))
    keys = (ranged.withColumn("_p", F.explode(F.concat(covered, whole)))
            .withColumn("_a", F.explode(F.when(no_age, any_age).otherwise(ages)))
            .withColumn("professional", F.explode(_wanted("professionals"))).withColumn("city", F.explode(_wanted("cities")))
            .select("task", F.col("_p.ask").alias("ask"), F.col("_p.period").alias("period"), F.col("_p.of").alias("of"),
                    F.col("_a.level").alias("age_level"), F.col("_a.block").alias("age_block"), "professional", "city",
                    F.coalesce(F.concat(F.lit("="), "wanted_sex"), F.lit(ANY)).alias("sex")))
    totals = keys.join(rolled, KEYS).groupBy("task").agg(*added)
    out = typed.select("task_id", "task").join(totals, "task", "left")
    count = F.coalesce("_n", F.lit(0)).cast("bigint")
    return out.select("task_id", count.alias("session_count"),
                      *[ratio_half_up(F.coalesce(F.col(n), F.lit(0)), count).alias(n) for _, _, n in names])
