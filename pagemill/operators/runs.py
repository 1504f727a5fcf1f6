"""Running values over the rows of a document, in tasks of bounded size.

A window over a whole document puts the document into one task, however large it is. Here a document
is cut into runs of pages. The last state of every run is summed up where the rows lie, the few
summaries of a document meet and give each run its opening state, and that state is put before the
rows of the run as one more row. A window over the run then carries both alike: no join, and the rows
move once, by document and run. The summaries read only the columns they need.

Rows without a page form a run of their own, before all others; null orders before every value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Pages of a run.
PAGES = 256

# places of the rows in a run: the opening state, events, rows
_OPENING, _EVENT, _ROW = 0, 1, 2


def _run_of(page: str, pages: int) -> Column:
    return F.coalesce(F.floor(F.col(page) / pages), F.lit(-1)).cast("bigint")


def scan(df: DataFrame, carries: dict[str, Column] | None = None, sums: dict[str, Column] | None = None, events: DataFrame | None = None, part: str = "doc_id", order: tuple[str, ...] = ("page", "order_id"), pages: int = PAGES) -> DataFrame:
    """``df`` with running columns in the order of ``order`` within ``part``.

    ``carries``: the last value up to the row that isn't null. ``sums``: the sum up to the row.
    ``events`` (part, order columns, names of carries) are values that stand right before the rows of
    their place without being rows. A row's columns of the added names are replaced.
    """
    carries, sums = carries or {}, sums or {}
    value = lambda n: f"_v_{n}"
    placed = lambda x, kind: x.withColumn("_run", _run_of(order[0], pages)).withColumn("_k", F.lit(kind))
    rows = placed(df, _ROW).withColumns({value(n): c for n, c in {**carries, **sums}.items()})
    slim = rows.select(part, "_run", *order, "_k", *(value(n) for n in (*carries, *sums)))
    given = None
    if events is not None:
        given = placed(events.select(part, *order, *(F.col(n).alias(value(n)) for n in carries)), _EVENT)
        slim = slim.unionByName(given, allowMissingColumns=True)

    at = F.struct(*order, "_k")
    ends = [F.max_by(value(n), F.when(F.col(value(n)).isNotNull(), at)).alias(value(n)) for n in carries]
    ends += [F.sum(value(n)).alias(value(n)) for n in sums]
    before = Window.partitionBy(part).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    state = [F.last(value(n), ignorenulls=True).over(before).alias(value(n)) for n in carries]
    state += [F.sum(value(n)).over(before).alias(value(n)) for n in sums]
    opening = slim.groupBy(part, "_run").agg(*ends).select(part, "_run", F.lit(_OPENING).alias("_k"), *state)

    every = rows.unionByName(opening, allowMissingColumns=True)
    if given is not None:
        every = every.unionByName(given, allowMissingColumns=True)
    so_far = Window.partitionBy(part, "_run").orderBy((F.col("_k") == _OPENING).desc(), *order, "_k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = {n: F.last(value(n), ignorenulls=True).over(so_far) for n in carries}
    out |= {n: F.coalesce(F.sum(value(n)).over(so_far), F.lit(0)) for n in sums}
    # under names that no column of the rows has, until the rows are told from the rest
    done = every.withColumns({f"_o_{n}": c for n, c in out.items()}).where(F.col("_k") == _ROW)
    return done.select(*(c for c in df.columns if c not in out), *(F.col(f"_o_{n}").alias(n) for n in out))


def number_stretches(df: DataFrame, value: str, name: str, part: str = "doc_id", order: tuple[str, ...] = ("page", "order_id"), pages: int = PAGES) -> DataFrame:
    """``df`` with the number, from 0, of the stretch of equal neighbouring values that a row lies in."""
    keys = [part, "_run"]
    rows = df.withColumn("_run", _run_of(order[0], pages)).withColumn("_k", F.lit(_ROW))
    inner = Window.partitionBy(*keys).orderBy(*order)
    first = F.row_number().over(inner) == 1
    changed = F.when(first | F.lag(value).over(inner).eqNullSafe(F.col(value)), 0).otherwise(1)
    at, wrapped = F.struct(*order), F.struct(F.col(value).alias("v"))
    slim = rows.select(*keys, *order, value).withColumn("_c", changed)
    runs = slim.groupBy(*keys).agg(F.min_by(wrapped, at).alias("head"), F.max_by(wrapped, at).alias("tail"), F.sum("_c").alias("n"))

    outer = Window.partitionBy(part).orderBy("_run")
    opens = F.when((F.row_number().over(outer) == 1) | F.lag("tail").over(outer).eqNullSafe(F.col("head")), 0).otherwise(1)
    earlier = F.coalesce(F.sum(F.col("n") + F.col("_o")).over(outer.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    opening = runs.withColumn("_o", opens).select(*keys, (earlier + F.col("_o")).alias("_base"), F.lit(_OPENING).alias("_k"))

    every = rows.unionByName(opening, allowMissingColumns=True)
    along = Window.partitionBy(*keys).orderBy("_k", *order)
    place = F.row_number().over(along)
    step = F.when(place == 1, F.col("_base")).when(place == 2, 0).when(F.lag(value).over(along).eqNullSafe(F.col(value)), 0).otherwise(1)
    number = F.sum("_step").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return every.withColumn("_step", step).withColumn(f"_o_{name}", number).where(F.col("_k") == _ROW).select(*df.columns, F.col(f"_o_{name}").alias(name))
