"""Row listings with computed text columns.

Filters are written so they reach the Parquet scan (ranges and equalities on
stored columns); formatting happens last, on the surviving rows.
"""

from __future__ import annotations

import decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.functions import (day_de_month, dec, fixed2, has_word_starting, in_year, mail_domain,
                             mask_id, money, round0, title_case)
from quill.functions.case import simple_case
from quill.plans import fixed as FX
from quill.plans.context import Ctx
from quill.plans.people import person_id, salary
from quill.sources.layout import inverted_by_word, keyed_by, with_word_starting
from quill.sources.params import exact

D = decimal.Decimal

PAYMENT_LABELS = {1: "cash", 2: "debit card", 3: "credit card"}


def salary_listing(ctx: Ctx, low: float = 650, high: float = 3000) -> DataFrame:
    """Customers with balance in [low, high] with nation and region;
    sorted by nation descending, then by the raw balance (not shown)."""
    c = ctx.t.customer.filter(F.col("c_acctbal").between(low, high))
    j = (c.join(ctx.t.nation, c.c_nationkey == F.col("n_nationkey"))
         .join(ctx.t.region, F.col("n_regionkey") == F.col("r_regionkey")))
    return (j.orderBy(F.col("n_name").desc_nulls_first(), F.col("c_acctbal").asc_nulls_last(),
                      "c_custkey")
            .select(person_id().alias("national_id"), F.upper("c_name").alias("full_name"),
                    F.col("r_name").alias("worker_type"), F.col("n_name").alias("city"),
                    money(salary()).alias("base_salary")))


def invoice_listing(ctx: Ctx, low: int = 100_000, high: int = 250_000,
                    vat: str = FX.VAT_RATE) -> DataFrame:
    """Orders of the year before the run date as invoices: Spanish day
    text, net/VAT/total money, amount class and payment form by code."""
    o = ctx.t.orders.filter(in_year("o_orderdate", ctx.as_of.year - 1))
    net = dec("o_totalprice")
    tax = round0(net * F.lit(exact(vat)))
    total = net + tax
    code = F.substring("o_orderpriority", 1, 1).cast("int")
    return (o.orderBy(F.col("o_orderdate").desc_nulls_first(), F.col("o_totalprice").desc_nulls_first(),
                      "o_orderkey")
            .select(F.col("o_orderkey").alias("invoice_no"),
                    day_de_month("o_orderdate").alias("issued"),
                    F.col("o_custkey").alias("client_id"),
                    money(net, symbol_in_mask=True).alias("net_amount"),
                    money(tax, symbol_in_mask=True).alias("vat_amount"),
                    money(total, symbol_in_mask=True).alias("total_amount"),
                    F.when(total <= low, "low").when(total <= high, "medium").otherwise("high")
                    .alias("amount_class"),
                    simple_case(code, PAYMENT_LABELS, "cheque").alias("payment_form")))


# Credit line by segment; 0 means no credit line (left out by the guard).
CREDIT_LINES = {"AUTOMOBILE": 6000, "BUILDING": 4000, "FURNITURE": 8000, "HOUSEHOLD": 0,
                "MACHINERY": 5000}


def client_credit(ctx: Ctx, state: str = "A", credit=None) -> DataFrame:
    """Clients in one state with a credit line: masked id, title-cased name,
    phone and district (a text where missing), credit status by the
    balance/credit ratio (compared cross-multiplied, so 0.8 exactly is not
    critical) and the mail domain.

    The state is A for nations up to 19, B above; every tenth client has no
    phone; the credit line goes by segment (``CREDIT_LINES``), or is ``credit``
    for every segment that has one."""
    lines = {k: v if credit is None or not v else credit for k, v in CREDIT_LINES.items()}
    c = (ctx.t.customer.withColumn("_state", F.when(F.col("c_nationkey") < 20, "A").otherwise("B"))
         .withColumn("_credit", simple_case(F.col("c_mktsegment"), lines, 0).cast("decimal(10,0)"))
         .filter((F.col("_state") == state) & (F.col("_credit") > 0)))
    bal, cr = salary(), F.col("_credit")
    ident = F.regexp_replace("c_name", "#", "-")
    mail = F.lower(F.regexp_replace("c_name", "#", "@"))
    phone = F.when(F.pmod("c_custkey", F.lit(10)) != 0, F.col("c_custkey") + 20_000_000)
    status = (F.when(bal > F.lit(D(FX.CREDIT_RATIO_CRITICAL)) * cr, F.lit("critical"))
              .when(bal > F.lit(D(FX.CREDIT_RATIO_REGULAR)) * cr,
                    F.concat(F.lit("regular ("), money(bal, symbol_in_mask=True), F.lit(")")))
              .otherwise(F.concat(F.lit("good ("), money(cr - bal, symbol_in_mask=True),
                                  F.lit(")"))))
    return (c.select(mask_id(ident).alias("masked_id"), title_case("c_name").alias("client"),
                     F.coalesce(phone.cast("string"), F.lit("no phone")).alias("phone"),
                     F.coalesce(F.col("c_nationkey").cast("string"), F.lit("no district"))
                     .alias("district"),
                     F.col("_state").alias("state"), status.alias("credit_status"),
                     F.coalesce(mail_domain(mail), F.lit("no mail")).alias("mail_domain"))
            .orderBy(F.col("client").asc_nulls_last(), "masked_id"))


def stock_report(ctx: Ctx, word: str = "ring", origin: str = "ECONOMY", rate=950, low: int = 10,
                 high: int = 30, offer_min: int = 40, offer_factor=FX.OFFER_FACTOR) -> DataFrame:
    """Parts of one origin (type) whose name has a word starting with
    ``word`` (INITCAP LIKE): cost text, converted cost at ``rate``, stock
    alert by two thresholds and an offer price above ``offer_min`` units."""
    return _stock_rows(ctx.t.part.filter(has_word_starting("p_name", word) & (F.col("p_type") == origin)),
                       rate, low, high, offer_min, offer_factor)


def stock_report_layout(ctx: Ctx, word: str = "ring", origin: str = "ECONOMY", rate=950, low: int = 10,
                        high: int = 30, offer_min: int = 40, offer_factor=FX.OFFER_FACTOR) -> DataFrame:
    """R6 through an inverted table of the names' words (A14): the word prefix is
    pushed into the scan of the sorted words, and its parts join back."""
    words = inverted_by_word(ctx.store, ctx.t.part, "part_words", "p_partkey", "p_name")
    found = with_word_starting(ctx.t.part.filter(F.col("p_type") == origin), words, "p_partkey", word)
    return _stock_rows(found, rate, low, high, offer_min, offer_factor)


def _stock_rows(p: DataFrame, rate, low: int, high: int, offer_min: int, offer_factor) -> DataFrame:
    price = dec("p_retailprice")
    stock = F.col("p_size")
    return (p.select(
        F.col("p_partkey").alias("part_id"), F.col("p_name").alias("description"),
        F.when(price.isNull(), "no record").otherwise(F.concat(fixed2(price), F.lit(" USD")))
        .alias("cost_usd"),
        F.when(price.isNull(), "no record").otherwise(money(round0(price * F.lit(exact(rate)))))
        .alias("cost_local"),
        stock.alias("stock"),
        F.when(stock.isNull(), "no data").when(stock < low, "stock very low")
        .when((stock >= low) & (stock <= high), "restock soon").otherwise("ok")
        .alias("stock_alert"),
        F.when(stock > offer_min, money(round0(price * F.lit(exact(offer_factor)))))
        .otherwise("n/a").alias("offer_price"))
        .orderBy(F.col("part_id").desc_nulls_first()))


def income_bands(ctx: Ctx, min_income: float = -1000, max_income: float = 9000) -> DataFrame:
    """Clients with income in the parameter range and a known category,
    with an income band (first matching arm wins)."""
    c = ctx.t.customer.filter(F.col("c_acctbal").between(min_income, max_income)
                              & F.col("c_mktsegment").isNotNull())
    inc = salary()
    band = (F.when(inc > 5000, "band 1").when(inc.between(4000, 5000), "band 2")
            .when(inc.between(F.lit(D(2000)), F.lit(D("3999.99"))), "band 3")
            .when(inc < 2000, "band 4").otherwise("unclassified"))
    return (c.select(person_id().alias("national_id"), F.col("c_name").alias("full_name"),
                     money(inc, symbol_in_mask=True).alias("income"), band.alias("income_band"))
            .orderBy(F.col("full_name").asc_nulls_last()))


def _part_row(p: DataFrame) -> DataFrame:
    return p.select("p_partkey", "p_name", "p_brand", "p_size",
                    dec("p_retailprice").alias("p_retailprice"))


def lookup_plain(ctx: Ctx, name: str = "hot ring") -> DataFrame:
    """Exact-name lookup; the equality is pushed into the Parquet scan."""
    return _part_row(ctx.t.part.filter(F.col("p_name") == name))


def lookup_by_upper(ctx: Ctx, name: str = "HOT RING") -> DataFrame:
    """``UPPER(name) = :x``. A function of the column cannot be pushed
    down (only IsNotNull reaches the scan); see :func:`lookup_upper_layout`."""
    return _part_row(ctx.t.part.filter(F.upper("p_name") == name))


def lookup_upper_layout(ctx: Ctx, name: str = "HOT RING") -> DataFrame:
    """R15b through the function-index re-aim (A14): the upper-cased name is
    stored as a sorted key column, so the equality is pushed into the scan
    and row groups are skipped by their min/max statistics."""
    t = keyed_by(ctx.store, ctx.t.part, "part_by_upper_name", "name_key", F.upper("p_name"))
    return _part_row(t.filter(F.col("name_key") == name))
