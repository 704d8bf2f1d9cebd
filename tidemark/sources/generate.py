"""Warehouse rows computed from a column of ids ``i``, defects included.

Every generator is a projection over its id DataFrame, so it runs on as many
tasks as the ids have partitions and yields the same rows under any partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.columns import date_key, sunday_week

# Word lists the generated names and attributes are drawn from.
FIRST_NAMES = [
    "John", "Jane", "Michael", "Sarah", "David", "Emily", "Robert", "Lisa", "James", "Jennifer", "William",
    "Linda", "Richard", "Patricia", "Joseph", "Elizabeth", "Thomas", "Maria", "Charles", "Susan",
]
LAST_NAMES = [
    "Smith", "Johnson", "Williams", "Brown", "Jones", "Garcia", "Miller", "Davis", "Rodriguez", "Martinez",
    "Hernandez", "Lopez", "Gonzalez", "Wilson", "Anderson", "Thomas", "Taylor", "Moore", "Jackson", "Martin",
]
COUNTRIES = [
    "USA", "Canada", "UK", "Germany", "France", "Spain", "Italy", "Australia", "Japan", "Brazil",
]
PRODUCT_LETTERS = [
    "A", "B", "C", "D", "E", "F", "G", "H", "I", "J",
]
PRODUCT_GRADES = [
    "Premium", "Standard", "Economy", "Deluxe", "Professional", "Basic", "Advanced", "Ultimate", "Classic",
    "Modern",
]
PRODUCT_KINDS = [
    "Widget", "Gadget", "Device", "Tool", "Instrument", "Apparatus", "Equipment", "Machine", "System",
    "Component",
]
CATEGORIES = ["Electronics", "Clothing", "Food", "Books", "Home"]
SUBCATEGORIES = ["Accessories", "Main Items", "Supplies", "Parts", "Bundles"]
HOLIDAYS = [(1, 1), (7, 4), (12, 25)]


def _word(words: list[str], position: Column) -> Column:
    """The word at a zero-based position, counted round the list."""
    listed = F.array(*[F.lit(w) for w in words])
    return F.element_at(listed, (position % len(words) + 1).cast("int"))


def _money(column: Column) -> Column:
    return column.cast("decimal(10,2)")


def days_covered(df: DataFrame, day: str) -> DataFrame:
    """Every calendar day from the first to the last day found in ``df``."""
    ends = df.agg(F.min(F.to_date(day)).alias("first"), F.max(F.to_date(day)).alias("last"))
    return ends.select(F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 DAY"))).alias("date"))


def date_dimension(days: DataFrame, iso_weeks: bool = True) -> DataFrame:
    """Calendar attributes for a DataFrame of ``date`` values.

    ``iso_weeks=False`` numbers weeks from their Sunday instead.
    """
    date = F.col("date")
    month, day = F.month(date), F.day(date)
    holiday = F.lit(False)
    for holiday_month, holiday_day in HOLIDAYS:
        holiday = holiday | ((month == holiday_month) & (day == holiday_day))
    iso_day = F.weekday(date) + 1
    return days.select(
        date_key(date).alias("date_id"),
        date,
        F.year(date).alias("year"),
        F.quarter(date).alias("quarter"),
        month.alias("month"),
        F.date_format(date, "MMMM").alias("month_name"),
        (F.weekofyear(date) if iso_weeks else sunday_week(date)).alias("week"),
        iso_day.alias("day_of_week"),
        F.date_format(date, "EEEE").alias("day_name"),
        (iso_day >= 6).alias("is_weekend"),
        holiday.alias("is_holiday"),
    )


def customers(ids: DataFrame) -> DataFrame:
    """Customers; every fiftieth has no email, segments split 20/40/40."""
    i = F.col("i")
    first, last = _word(FIRST_NAMES, i), _word(LAST_NAMES, F.expr("i div 20"))
    address = F.concat(F.lower(F.concat(first, F.lit("."), last)), i.cast("string"), F.lit("@example.com"))
    decile = i % 10
    return ids.select(
        F.concat(F.lit("CUST-"), F.lpad(i.cast("string"), 5, "0")).alias("customer_key"),
        F.concat_ws(" ", first, last).alias("customer_name"),
        F.when(i % 50 != 0, address).alias("email"),
        _word(COUNTRIES, i).alias("country"),
        F.when(decile < 2, "Enterprise").when(decile < 6, "SMB").otherwise("Consumer").alias("segment"),
    )


def products(ids: DataFrame) -> DataFrame:
    i = F.col("i")
    tens, fives = F.expr("i div 10"), F.expr("i div 5")
    return ids.select(
        F.concat(F.lit("PROD-"), _word(PRODUCT_LETTERS, i), F.lpad(tens.cast("string"), 3, "0")).alias("product_key"),
        F.concat_ws(" ", _word(PRODUCT_GRADES, i), _word(PRODUCT_KINDS, tens)).alias("product_name"),
        _word(CATEGORIES, i).alias("category"),
        _word(SUBCATEGORIES, fives).alias("subcategory"),
        _money(5 + (i % 100) * 5).alias("unit_price"),
    )


def _sale(ids: DataFrame, key: Column, customer: Column, step: int, day: Column, quantity: Column,
          price: Column, discount: Column, undiscounted: Column, *extra: Column) -> DataFrame:
    """The fact columns; the total leaves the discount out where ``undiscounted``."""
    gross = quantity * price
    return ids.select(
        key.alias("transaction_id"),
        customer.alias("customer_id"),
        (1 + (F.col("i") * step) % 500).alias("product_id"),
        date_key(day).alias("sale_date_id"),
        quantity.cast("int").alias("quantity"),
        _money(price).alias("unit_price"),
        _money(discount).alias("discount"),
        F.when(undiscounted, gross).otherwise(gross - discount).cast("decimal(12,2)").alias("total_amount"),
        *extra,
    )


def _tenths(amount: int, by: int) -> Column:
    """(i mod by) * amount / 10, in exact decimals."""
    return ((F.col("i") % by) * amount).cast("decimal(10,2)") / F.lit(10).cast("decimal(2,0)")


def _txn(prefix: str, number: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"))


def _day(first: str, spread: int) -> Column:
    return F.date_add(F.lit(first).cast("date"), (F.col("i") % spread).cast("int"))


def sales(ids: DataFrame, wrong_total_every: int = 200) -> DataFrame:
    """Sales facts: 2% without customer, 1% negative quantity, 0.5% totals without the discount.

    With the default period the affected rows have a zero discount, so their totals
    come out right after all; a period such as 201 yields totals that are really wrong.
    """
    i = F.col("i")
    units = 1 + i % 10
    return _sale(
        ids,
        _txn("TXN-", i, 8),
        F.when(i % 50 != 0, 1 + i % 1000),
        7,
        _day("2020-01-01", 1826),
        F.when(i % 100 == 0, -units).otherwise(units),
        10 + (i % 50) * 5,
        _tenths(25, 20),
        i % wrong_total_every == 0,
    )


def repeated_sales(ids: DataFrame) -> DataFrame:
    """Sales whose transaction ids cycle through 1,000 values."""
    i = F.col("i")
    return _sale(
        ids, _txn("TXN-", i % 1000, 8), 1 + i % 1000, 11, _day("2020-01-01", 365), 1 + i % 5,
        15 + (i % 30) * 5, _tenths(20, 10), F.lit(False),
    )


def staging_sales(ids: DataFrame) -> DataFrame:
    """Unprocessed sales from the point-of-sale system."""
    i = F.col("i")
    return _sale(
        ids, _txn("TXN-STAGE-", i, 6), 1 + i % 1000, 13, _day("2024-10-01", 15), 1 + i % 5,
        20 + (i % 40) * 5, _tenths(30, 15), F.lit(False),
        F.lit("POS_SYSTEM").alias("source_system"), F.lit(False).alias("is_processed"),
    )


def scd_rows(ids: DataFrame) -> DataFrame:
    """Customers whose country and segment follow the id modulo three."""
    i = F.col("i")
    third = i % 3
    return ids.select(
        _txn("CUST-", i, 3).alias("customer_key"),
        F.concat(F.lit("Customer "), i.cast("string")).alias("customer_name"),
        F.concat(F.lit("customer"), i.cast("string"), F.lit("@example.com")).alias("email"),
        F.when(third == 0, "USA").when(third == 1, "Canada").otherwise("UK").alias("country"),
        F.when(third == 0, "Enterprise").when(third == 1, "SMB").otherwise("Consumer").alias("segment"),
    )


# Draws are numbered so that each has its own sequence of values.
DRAWS = (
    "first last email country segment duplicate earlier orphan customer product day "
    "negative returned quantity price discount wrong"
).split()
DRAW_PRIME = 2147483647


def _draw(tag: str, seed: int) -> Column:
    """A number in [0, 1) fixed by id, tag and seed.

    Two squarings modulo a prime, in long arithmetic only: the same value under retries,
    any partitioning, and in any other engine.
    """
    prime = F.lit(DRAW_PRIME).cast("bigint")
    shift = seed * 69621 + DRAWS.index(tag) * 40692
    start = ((F.col("i") % prime) * 48271 + shift) % prime
    squared = (start * start + shift) % prime
    return (squared * squared + start) % prime / F.lit(float(DRAW_PRIME))


def customers_at_rate(ids: DataFrame, seed: int = 42, null_email_rate: float = 0.02) -> DataFrame:
    """Customers with attributes drawn per row; segments again split 20/40/40."""
    i = F.col("i")
    first, last = (_word(w, F.floor(_draw(t, seed) * len(w))) for t, w in (("first", FIRST_NAMES), ("last", LAST_NAMES)))
    address = F.concat(F.lower(F.concat(first, F.lit("."), last)), i.cast("string"), F.lit("@example.com"))
    segment = _draw("segment", seed)
    return ids.select(
        _txn("CUST-", i, 5).alias("customer_key"),
        F.concat_ws(" ", first, last).alias("customer_name"),
        F.when(_draw("email", seed) >= null_email_rate, address).alias("email"),
        _word(COUNTRIES, F.floor(_draw("country", seed) * len(COUNTRIES))).alias("country"),
        F.when(segment < 0.2, "Enterprise").when(segment < 0.6, "SMB").otherwise("Consumer").alias("segment"),
    )


def staging_at_rates(ids: DataFrame, seed: int = 42, source_system: str = "POS_SYSTEM", **rates) -> DataFrame:
    """Unprocessed sales drawn per row, by default without defects."""
    clean = {
        "null_customer_rate": 0.0, "negative_quantity_rate": 0.0, "wrong_total_rate": 0.0, "duplicate_rate": 0.0,
    }
    drawn = sales_at_rates(ids, seed, **{**clean, **rates})
    return drawn.select(
        F.replace("transaction_id", F.lit("TXN-"), F.lit("TXN-STAGE-")).alias("transaction_id"),
        *[c for c in drawn.columns if c != "transaction_id"],
        F.lit(source_system).alias("source_system"),
        F.lit(False).alias("is_processed"),
    )


def sales_at_rates(
    ids: DataFrame,
    seed: int = 42,
    customer_count: int = 100,
    product_count: int = 50,
    first_day: str = "2024-01-01",
    last_day: str = "2024-12-31",
    null_customer_rate: float = 0.02,
    negative_quantity_rate: float = 0.01,
    wrong_total_rate: float = 0.005,
    duplicate_rate: float = 0.03,
) -> DataFrame:
    """Sales with each defect drawn per row at a given rate."""
    i = F.col("i")

    def below(tag: str, count) -> Column:
        return F.floor(_draw(tag, seed) * count).cast("int")

    def hit(tag: str, rate: float) -> Column:
        return _draw(tag, seed) < rate

    number = F.when(hit("duplicate", duplicate_rate), F.floor(_draw("earlier", seed) * i)).otherwise(i)
    first = F.lit(first_day).cast("date")
    days = F.date_diff(F.lit(last_day).cast("date"), first) + 1
    units = 1 + below("quantity", 10)
    quantity = F.when(hit("negative", negative_quantity_rate), -(1 + below("returned", 5))).otherwise(units)
    price, discount = below("price", 100), below("discount", 10)
    gross = quantity * price
    return ids.select(
        _txn("TXN-", number, 8).alias("transaction_id"),
        F.when(~hit("orphan", null_customer_rate), 1 + below("customer", customer_count)).alias("customer_id"),
        (1 + below("product", product_count)).alias("product_id"),
        date_key(F.date_add(first, below("day", days))).alias("sale_date_id"),
        quantity.alias("quantity"),
        _money(price).alias("unit_price"),
        _money(discount).alias("discount"),
        F.when(hit("wrong", wrong_total_rate), gross).otherwise(gross - discount)
        .cast("decimal(12,2)").alias("total_amount"),
    )
