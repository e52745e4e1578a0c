"""Checks and repairs of the shop tables. Each is one job over a whole table."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwise.functions.domains import (
    ACCEPTED, CATEGORY_PRICE_BAND, PAGE_DURATION_BAND, inside, region_of,
)
from tillwise.functions.numbers import exact_sum, round_to
from tillwise.functions.times import moment
from tillwise.operators.dimensions import first_per_key
from tillwise.operators.skew import join_per_key


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def null_profile(df: DataFrame, table: str) -> DataFrame:
    """Row count, NULL count and NULL rate of every column that is no key (``..._id``)."""
    columns = [c for c in df.columns if not c.endswith("_id")]
    counted = df.agg(F.count("*").alias("n_rows"),
                     *(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return (counted.unpivot("n_rows", columns, "column_name", "n_nulls")
            .select(F.lit(table).alias("table_name"), "column_name", "n_rows", "n_nulls",
                    round_to(F.try_divide("n_nulls", "n_rows"), 4).alias("null_rate")))


def duplicate_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows (or values of the given columns) that occur more than once, and how often."""
    return (df.groupBy(*(columns or df.columns)).agg(F.count("*").alias("copies"))
            .filter("copies > 1"))


def dedup_rows(df: DataFrame) -> DataFrame:
    """One of each row."""
    return df.dropDuplicates()


def dedup_stream(df: DataFrame, columns: list[str], within: str = "1 hour",
                 arrival: str = "arrived_at") -> DataFrame:
    """One of the rows that agree in ``columns`` and arrive within a bound of each other.

    The bound is on arrival, stamped here, not on a date in the row: rows may come in any order of
    their dates and none is too late. State older than the bound is dropped.
    """
    return (df.withColumn(arrival, F.current_timestamp()).withWatermark(arrival, within)
            .dropDuplicatesWithinWatermark(columns).drop(arrival))


def email_check(clients: DataFrame) -> DataFrame:
    """Clients whose e-mail has no ``@``. Where ``at`` occurs once, in a place that leaves a
    well-formed address, the repaired address is given; elsewhere it is ambiguous and NULL."""
    email = F.col("email")
    once = F.size(F.split(email, "at")) == 2
    candidate = F.replace(email, F.lit("at"), F.lit("@"))
    well_formed = candidate.rlike(r"^[^@\s]+@[^@\s]+\.[^@\s]+$")
    return (clients.filter(email.isNotNull() & ~email.contains("@"))
            .select("client_id", "email",
                    F.when(once & well_formed, candidate).alias("repaired_email")))


def age_check(clients: DataFrame, low: float = 10, high: float = 100) -> DataFrame:
    """Clients whose age is out of range, bounds allowed."""
    return clients.filter(~F.col("age").between(low, high)).select("client_id", "age")


def mend_ages(clients: DataFrame, low: float = 10, high: float = 100) -> DataFrame:
    """The table with ages out of range set to NULL."""
    age = F.col("age")
    return clients.withColumn("age", F.when(age.between(low, high), age))


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Key values of the child table that the parent lacks, with the number of child rows.

    Both sides are reduced per key first, so a hot key meets the join as one row.
    """
    counted = (child.filter(F.col(key).isNotNull()).groupBy(key)
               .agg(F.count("*").alias("n_rows")))
    return counted.join(parent.select(key).distinct(), key, "left_anti")


def ref_integrity(relations: dict[str, tuple[DataFrame, DataFrame, str]]) -> DataFrame:
    """Per relation: how many distinct keys and how many rows point nowhere."""
    return _union([
        orphans(child, parent, key)
        .agg(F.count("*").alias("orphan_keys"),
             F.coalesce(F.sum("n_rows"), F.lit(0)).alias("orphan_rows"))
        .select(F.lit(name).alias("relation"), "orphan_keys", "orphan_rows")
        for name, (child, parent, key) in relations.items()])


def order_total_check(orders: DataFrame, items: DataFrame, tolerance: float = 0.005) -> DataFrame:
    """Orders whose total differs from the sum of their rounded item totals; an order without items
    has an items total of 0, and ``has_items`` tells.

    Equal order rows come out once with their number in ``copies``: both sides of the join are
    aggregated, so neither a repeated order nor an order with very many items is a hot key.
    """
    line = round_to(F.col("unit_price") * F.col("quantity"), 2)
    per_order = items.groupBy("order_id").agg(exact_sum(line, scale=2).alias("items_total"))
    stated = orders.groupBy("order_id", "total_amount").agg(F.count("*").alias("copies"))
    difference = F.col("total_amount") - F.col("items_total")
    joined = stated.join(per_order.withColumn("has_items", F.lit(True)), "order_id", "left").withColumns({
        "items_total": F.coalesce("items_total", F.lit(0.0)),
        "has_items": F.coalesce("has_items", F.lit(False))})
    return (joined.filter(F.abs(difference) > tolerance)
            .select("order_id", "total_amount", "items_total",
                    round_to(difference, 2).alias("difference"), "copies", "has_items"))


def date_order_check(events: DataFrame, clients: DataFrame, id_column: str,
                     date_column: str) -> DataFrame:
    """Orders or incidents dated before their client's earliest registration."""
    registered = clients.groupBy("client_id").agg(
        F.min("registration_date").alias("registration_date"))
    return (join_per_key(events.select(id_column, "client_id", date_column), registered,
                         "client_id")
            .filter(F.col(date_column) < F.col("registration_date")))


def segment_rule(clients: DataFrame, as_of: datetime | str | None = None,
                 days: int = 182) -> DataFrame:
    """The segment each client should have: new within the last days, else regular."""
    limit = moment(as_of) - F.make_dt_interval(days=F.lit(days))
    due = F.when(F.col("registration_date") >= limit, "new").otherwise("regular")
    return clients.select("client_id", "registration_date", "segment",
                          due.alias("expected_segment"))


def region_check(orders: DataFrame, clients: DataFrame,
                 regions: dict[str, str] | None = None) -> DataFrame:
    """Orders per stated region and region expected from the client's country."""
    homes = clients.groupBy("client_id").agg(F.min("country").alias("country"))
    counted = orders.groupBy("client_id", "region").agg(F.count("*").alias("n"))
    return (counted.join(homes, "client_id", "left")
            .groupBy("country", "region", region_of(F.col("country"), regions)
                     .alias("expected_region"))
            .agg(F.sum("n").alias("nb_orders")))


def resolution_rule(incidents: DataFrame) -> DataFrame:
    """Incidents whose resolution time cannot be: given while in progress, or over the limit of
    24 h for critical and 168 h for other priorities."""
    hours, open_ = F.col("resolution_time_h"), F.col("status") == "In progress"
    limit = F.when(F.col("priority") == "Critical", 24.0).otherwise(168.0)
    broken = F.when(open_ & hours.isNotNull(), "time_while_open").when(hours > limit, "over_limit")
    return (incidents.withColumn("violation", broken).filter(F.col("violation").isNotNull())
            .select("incident_id", "status", "priority", "resolution_time_h", "violation"))


def price_band_check(items: DataFrame, products: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """Items priced outside the catalogue price plus or minus the tolerance."""
    catalogue = first_per_key(
        products.select("product_id", F.col("unit_price").alias("catalogue_price")), "product_id")
    price, base = F.col("unit_price"), F.col("catalogue_price")
    return (join_per_key(items.select("item_id", "product_id", "unit_price"), catalogue,
                         "product_id")
            .filter(~price.between(base * (1 - tolerance), base * (1 + tolerance)))
            .select("item_id", "product_id", "unit_price", "catalogue_price"))


def catalogue_band_check(products: DataFrame,
                         bands: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Products priced outside their category's band."""
    inside_band = inside(F.col("unit_price"), F.col("category"), bands or CATEGORY_PRICE_BAND)
    return products.filter(~inside_band).select("product_id", "category", "unit_price")


def duration_band_check(page_views: DataFrame,
                        bands: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Page views that lasted shorter or longer than their page's band."""
    inside_band = inside(F.col("duration_seconds"), F.col("page"), bands or PAGE_DURATION_BAND)
    return page_views.filter(~inside_band).select("session_id", "page", "duration_seconds")


def accepted_values(df: DataFrame, table: str,
                    accepted: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Values outside the accepted list of their column, with the number of rows. One pass."""
    lists = accepted or ACCEPTED[table]

    def strange(column: str) -> Column:
        value = F.col(column)
        return F.when(~value.isin(*lists[column]), value)

    return (df.select(*(strange(c).alias(c) for c in lists))
            .unpivot([], list(lists), "column_name", "value")
            .filter(F.col("value").isNotNull())
            .groupBy("column_name", "value").agg(F.count("*").alias("n_rows"))
            .select(F.lit(table).alias("table_name"), "column_name", "value", "n_rows"))


def seeded_sample(df: DataFrame, keys: list[str], fraction: float = 0.01, seed: int = 42,
                  most: int = 3) -> DataFrame:
    """A sample with replacement of exactly ``max(1, floor(fraction * rows))`` rows (none of an
    empty table), the same for a seed in any layout.

    Every row may come up to ``most`` times. Each of these chances has a number: the MD5 of seed,
    keys, place among rows of equal keys, and chance. The smallest numbers win. They are counted
    by their first four digits, so only the rows of one such group are ranked.
    """
    others = [c for c in df.columns if c not in keys]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*(others or keys)))
    drawn = (df.withColumn("_place", place)
             .withColumn("_chance", F.explode(F.sequence(F.lit(1), F.lit(most))))
             .withColumn("_number", F.md5(F.concat_ws("|", F.lit(seed), *(F.coalesce(F.col(k).cast("string"), F.lit(""))
                                                                         for k in keys), "_place", "_chance")))
             .withColumn("_group", F.left("_number", F.lit(4))))
    in_order = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = drawn.groupBy("_group").agg(F.count("*").alias("n"))  # at most 65,536 rows
    size = F.greatest(F.lit(1), F.floor(F.sum("n").over(Window.partitionBy()) / most * fraction))
    quota = groups.select("_group", (size - F.coalesce(F.sum("n").over(in_order), F.lit(0))).alias("_quota")
                          ).where("_quota > 0")
    rank = F.row_number().over(Window.partitionBy("_group").orderBy("_number"))
    return (drawn.join(quota, "_group").withColumn("_rank", rank).where("_rank <= _quota")
            .select(*df.columns))


# Draws that one task makes, and bits of a draw's number.
_DRAWS, _BITS = 1 << 16, 60
# Hex digits of a row's MD5 that name its part of the table.
_DIGITS = 4


def drawn_sample(df: DataFrame, keys: list[str], fraction: float = 0.01, seed: int = 42) -> DataFrame:
    """A sample with replacement of ``max(1, floor(fraction * rows))`` draws (none of an empty table),
    each of which may take any row, however often it was taken; the same for a seed in any layout.

    Rows stand in order of the MD5 of their keys, then of all columns; draw number i takes the row at
    the place that the MD5 of seed and i names, evenly over all places. Equal rows are counted first
    and hold as many places. A row's place is one within its part, the rows whose MD5 begins alike,
    and the parts are counted, so no task holds more than one part. A draw is dealt to its part, where
    the row at or before its place is looked up in order. ``keys`` are to tell rows apart: rows that
    agree in them fall in one part.
    """
    digest = F.md5(F.concat_ws("|", *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys)))
    whole = F.struct(*df.columns)
    rows = (df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
            .select(whole.alias("_row"), "_copies", digest.alias("_md5"))
            .withColumn("_part", F.conv(F.left("_md5", F.lit(_DIGITS)), 16, 10).cast("int")))
    before = Window.partitionBy("_part").orderBy("_md5", "_row").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.select("_part", F.coalesce(F.sum("_copies").over(before), F.lit(0)).alias("_place"), "_row")
    # At most 16^_DIGITS parts.
    in_order = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("_part").agg(F.sum("_copies").alias("_n")).withColumns({
        "_first": F.coalesce(F.sum("_n").over(in_order), F.lit(0)), "_rows": F.sum("_n").over(Window.partitionBy())})
    # The draws are made in blocks, and a block's draws in a task of its own.
    blocks = (parts.agg(F.max("_rows").alias("_rows")).where("_rows > 0")
              .withColumn("_draws", F.greatest(F.lit(1), F.floor(F.col("_rows") * fraction)).cast("bigint"))
              .withColumn("_block", F.explode(F.sequence(F.lit(0), F.expr(f"(_draws - 1) div {_DRAWS}")))).repartition("_block"))
    first = F.col("_block") * _DRAWS
    number = F.conv(F.left(F.md5(F.concat_ws("|", F.lit(seed), "_i")), F.lit(_BITS // 4)), 16, 10).cast("decimal(20,0)")
    draws = (blocks.withColumn("_i", F.explode(F.sequence(first + 1, F.least(first + _DRAWS, F.col("_draws")))))
             .withColumn("_at", F.floor(number * F.col("_rows").cast("decimal(17,0)") / F.lit(1 << _BITS).cast("decimal(20,0)"))
                         .cast("bigint")))
    # Parts and draws meet on cells of about a part's size: a part lies in two or three.
    size = f"greatest(1, _rows div {16 ** _DIGITS})"
    cells = parts.withColumn("_cell", F.explode(F.sequence(
        F.expr(f"_first div {size}"), F.expr(f"(_first + _n - 1) div {size}")))).drop("_rows")
    dealt = (draws.withColumn("_cell", F.expr(f"_at div {size}")).join(cells, "_cell")
             .where("_at >= _first AND _at < _first + _n")
             .select("_part", (F.col("_at") - F.col("_first")).alias("_place"), F.lit(True).alias("_drawn")))
    upto = Window.partitionBy("_part").orderBy("_place", F.col("_drawn").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    looked = placed.unionByName(dealt, allowMissingColumns=True).withColumn("_row", F.last("_row", True).over(upto))
    return looked.where("_drawn").select("_row.*")
