"""The 24 TPC-DS tables at any scale factor as lazy DataFrames.

Structure, keys and row counts follow the public specification; values are drawn anew. Most columns
follow from their name: foreign keys by suffix, identifiers by key, words by draw. What a table says
beyond that stands in its own method. A return is a function of the sale it belongs to, so returns are
computed from the sale's number without reading the sales.
"""

from __future__ import annotations

import math
from decimal import Decimal
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from benchloom.schemas import TPCDS_LAYOUT, benchmark
from benchloom.sources.drawing import choose, draw, finish, numbered, output_parts

# Rows of the public specification at these scale factors. Inventory follows from items and warehouses.
SCALES = (1, 10, 100, 1_000, 3_000, 10_000, 30_000, 100_000)
ROWS = {
    "call_center": (6, 24, 30, 42, 48, 54, 60, 60),
    "catalog_page": (11_718, 12_000, 20_400, 30_000, 36_000, 40_000, 46_000, 50_000),
    "customer": (100_000, 500_000, 2_000_000, 12_000_000, 30_000_000, 65_000_000, 80_000_000, 100_000_000),
    "customer_address": (50_000, 250_000, 1_000_000, 6_000_000, 15_000_000, 32_500_000, 40_000_000, 50_000_000),
    "customer_demographics": (1_920_800,) * 8,
    "date_dim": (73_049,) * 8,
    "household_demographics": (7_200,) * 8,
    "income_band": (20,) * 8,
    "item": (18_000, 102_000, 204_000, 300_000, 360_000, 402_000, 462_000, 502_000),
    "promotion": (300, 500, 1_000, 1_500, 1_800, 2_000, 2_300, 2_500),
    "reason": (35, 45, 55, 65, 67, 70, 72, 75),
    "ship_mode": (20,) * 8,
    "store": (12, 102, 402, 1_002, 1_350, 1_500, 1_704, 1_902),
    "time_dim": (86_400,) * 8,
    "warehouse": (5, 10, 15, 20, 22, 25, 27, 30),
    "web_page": (60, 200, 2_040, 3_000, 3_600, 4_002, 4_602, 5_004),
    "web_site": (30, 42, 24, 54, 66, 78, 84, 96),
}
#: Rows at scale 1 of the tables that grow with the scale factor.
LINEAR_ROWS = {
    "catalog_returns": 144_067,
    "catalog_sales": 1_441_548,
    "store_returns": 287_514,
    "store_sales": 2_880_404,
    "web_returns": 71_763,
    "web_sales": 719_384,
}
#: Below scale 1, where the specification says nothing, these stay whole and all others shrink with the scale factor.
WHOLE_BELOW_ONE = ("catalog_page", "date_dim", "household_demographics", "income_band", "ship_mode", "time_dim")
INVENTORY_WEEKS = 261
LINES_PER_TICKET = 12

# Day numbers (Julian) of the first calendar day and of the sales period.
FIRST_DAY_SK, FIRST_DAY = 2_415_022, "date'1900-01-02'"
FIRST_SALE_SK, SALE_DAYS = 2_450_815, 1_826

# Which table a foreign key points to, by the end of its name.
FOREIGN_KEYS = {
    "date_sk": "date_dim",
    "time_sk": "time_dim",
    "item_sk": "item",
    "customer_sk": "customer",
    "cdemo_sk": "customer_demographics",
    "hdemo_sk": "household_demographics",
    "addr_sk": "customer_address",
    "store_sk": "store",
    "call_center_sk": "call_center",
    "catalog_page_sk": "catalog_page",
    "ship_mode_sk": "ship_mode",
    "warehouse_sk": "warehouse",
    "promo_sk": "promotion",
    "web_page_sk": "web_page",
    "web_site_sk": "web_site",
    "reason_sk": "reason",
    "income_band_sk": "income_band",
}

#: Columns of a postal address, without the table's prefix.
ADDRESS = "street_number street_name street_type suite_number city county state zip country gmt_offset".split()

# Our own words.
PLAIN = "able,ought,anti,bar,cally,ation,eing,ese,pri,eseed,urban,local,public,early,recent,likely,major,social,formal,modern"
STREETS = "Main,Oak,Park,Elm,Cedar,Lake,Hill,Maple,Pine,River,Spring,Church,Walnut,Sunset,View,First,Second,Third"
STREET_TYPES = "Street,Avenue,Road,Lane,Court,Drive,Way,Circle,Blvd,Parkway"
CITIES = "Midway,Fairview,Oak Grove,Five Points,Pleasant Hill,Centerville,Riverside,Salem,Liberty,Greenville,Union,Bethel"
STATES = "TN,GA,AL,SD,OH,TX,CA,NY,WA,IL,MI,KS,VA,NC,IN,MN"
FIRST_NAMES = "James,Mary,John,Linda,Robert,Susan,David,Karen,William,Nancy,Thomas,Betty,Daniel,Helen,Paul,Sandra"
LAST_NAMES = "Smith,Jones,Brown,Davis,Miller,Wilson,Moore,Taylor,Thomas,White,Harris,Martin,Clark,Lewis,Walker,Hall"
COUNTRIES = "UNITED STATES,CANADA,MEXICO,BRAZIL,FRANCE,GERMANY,JAPAN,INDIA,KENYA,NORWAY,PERU,SPAIN"
CATEGORIES = "Women,Men,Children,Shoes,Music,Jewelry,Home,Sports,Books,Electronics"
COLORS = "red,blue,green,black,white,yellow,pink,brown,gray,orange,purple,navy,olive,ivory,coral,tan"
SIZES = "small,medium,large,extra large,petite,economy,N/A"
UNITS = "Each,Dozen,Case,Pallet,Gross,Box,Bunch,Pound,Ounce,Ton,Gram,Cup"
EDUCATION = "Primary,Secondary,College,2 yr Degree,4 yr Degree,Advanced Degree,Unknown"
RATINGS = "Low Risk,High Risk,Good,Unknown"
BUY_POTENTIAL = "0-500,501-1000,1001-5000,5001-10000,>10000,Unknown"
SHIP_TYPES = "REGULAR,EXPRESS,NEXT DAY,OVERNIGHT,TWO DAY,LIBRARY"
SHIP_CODES = "AIR,SURFACE,SEA,MAIL"
DAYS = "Sunday,Monday,Tuesday,Wednesday,Thursday,Friday,Saturday"


def row_counts(sf: Decimal) -> dict[str, int]:
    """Rows of each table: those listed, between two listed scale factors in proportion to the logarithms."""
    rows = {table: max(int(n * sf), 1) for table, n in LINEAR_ROWS.items()}
    for table, listed in ROWS.items():
        if sf < 1:
            rows[table] = listed[0] if table in WHOLE_BELOW_ONE else max(int(listed[0] * sf), 1)
            continue
        upper = min(next((i for i, scale in enumerate(SCALES) if scale >= sf), len(SCALES) - 1), len(SCALES) - 1)
        if upper == 0 or SCALES[upper] == sf:
            rows[table] = listed[upper]
            continue
        low, high = listed[upper - 1], listed[upper]
        share = math.log(float(sf) / SCALES[upper - 1]) / math.log(SCALES[upper] / SCALES[upper - 1])
        rows[table] = round(low * (high / low) ** share)
    rows["inventory"] = INVENTORY_WEEKS * max(rows["item"] // 2, 1) * rows["warehouse"]
    return {table: rows[table] for table in TPCDS_LAYOUT}


@lru_cache(maxsize=None)
def bare_columns(table: str) -> tuple[str, tuple[str, ...]]:
    """A table's column prefix and its column names without it."""
    names = [column for column, _ in benchmark("tpcds")[table]]
    prefix = names[0].split("_")[0] + "_"
    return prefix, tuple(name.removeprefix(prefix) for name in names)


def foreign_key_table(table: str, column: str) -> str | None:
    """Table that a column refers to; a table's own key refers to nothing."""
    prefix, names = bare_columns(table)
    bare = column[len(prefix):]
    if not bare.endswith("_sk") or bare == names[0] and table in ROWS:
        return None
    for ending, target in FOREIGN_KEYS.items():
        if bare.endswith(ending):
            return target
    return None


def foreign_keys() -> list[tuple[str, str, str, str]]:
    """All foreign keys as (child table, child column, parent table, parent key)."""
    keys = []
    for table, columns in benchmark("tpcds").items():
        for column, _ in columns:
            parent = foreign_key_table(table, column)
            if parent:
                keys.append((table, column, parent, benchmark("tpcds")[parent][0][0]))
    return keys


class Tpcds:
    """Generator for one scale factor. ``table(name)`` builds one table."""

    def __init__(self, spark: SparkSession, sf: Decimal | str | int, parts: int | None = None):
        self.spark, self.sf, self.parts = spark, Decimal(str(sf)), parts
        if self.sf <= 0:
            raise ValueError("the scale factor must be positive")
        self.rows = row_counts(self.sf)
        self.least = output_parts(self.sf)

    # --- rules by column name ---------------------------------------------------------------------

    def _tag(self, table: str, column: str) -> int:
        names = [c for c, _ in benchmark("tpcds")[table]]
        return 1000 * (list(TPCDS_LAYOUT).index(table) + 1) + names.index(column)

    def reference(self, parent: str, tag: int, key: str) -> str:
        """Uniform key of a parent table; one in 32 is unknown, as some are in the specification's data.

        Days come from the sales period, seconds start at 0. One drawn word serves both decisions.
        """
        word = f"xxhash64({tag}, {key})"
        rows = SALE_DAYS if parent == "date_dim" else self.rows[parent]
        first = {"date_dim": FIRST_SALE_SK, "time_dim": 0}.get(parent, 1)
        return f"if(({word} & 31) = 0, null, {first} + shiftrightunsigned({word}, 5) % {rows})"

    def _default(self, table: str, column: str, kind: str, key: str) -> str:
        prefix, _ = bare_columns(table)
        bare, tag = column[len(prefix):], self._tag(table, column)
        parent = foreign_key_table(table, column)
        if parent:
            return self.reference(parent, tag, key)
        if bare in ADDRESS:
            return self._street(bare, tag, key)
        if bare == "rec_start_date":
            return f"date'1997-03-13' + cast(365 * {draw(tag, key, 4)} as int)"
        if bare == "rec_end_date":
            return f"if({draw(tag, key, 2)} = 0, null, date'2001-03-12')"
        if kind == "S" and bare.endswith("_id"):
            return f"concat('AAAAAAAA', lpad(hex({key}), 8, 'A'))"
        if kind == "S":
            words = [choose(PLAIN, draw(tag + 500 * i, key, 20)) for i in range(2)]
            return f"concat_ws(' ', {', '.join(words)})"
        if kind == "D5_2":
            return f"{draw(tag, key, 12)}"
        return f"1 + {draw(tag, key, 100)}"

    def _street(self, bare: str, tag: int, key: str) -> str:
        return {
            "street_number": f"cast(1 + {draw(tag, key, 999)} as string)",
            "street_name": choose(STREETS, draw(tag, key, 18)),
            "street_type": choose(STREET_TYPES, draw(tag, key, 10)),
            "suite_number": f"concat('Suite ', cast({draw(tag, key, 50)} * 10 as string))",
            "city": choose(CITIES, draw(tag, key, 12)),
            "county": f"concat({choose(CITIES, draw(tag, key, 12))}, ' County')",
            "state": choose(STATES, draw(tag, key, 16)),
            "zip": f"lpad(cast({draw(tag, key, 99999)} as string), 5, '0')",
            "country": "'United States'",
            "gmt_offset": f"(-500 - 100 * {draw(tag, key, 4)})",
        }[bare]

    def _build(self, df: DataFrame, table: str, key: str, values: dict[str, str]) -> DataFrame:
        prefix, _ = bare_columns(table)
        given = {prefix + name: value for name, value in values.items()}
        full = {
            column: given.get(column) or self._default(table, column, kind, key)
            for column, kind in benchmark("tpcds")[table]
        }
        return finish(df, "tpcds", table, full)

    def _dimension(self, table: str, values: dict[str, str], start: int = 1) -> DataFrame:
        """Table keyed by a running number ``k``; its first column is the key unless given."""
        own = bare_columns(table)[1][0]
        df = numbered(self.spark, self.rows[table], "k", self.parts, 1, start)
        return self._build(df, table, "k", {own: "k", **values})

    def table(self, name: str) -> DataFrame:
        return getattr(self, f"_{name}")()

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in TPCDS_LAYOUT}

    # --- dimensions -------------------------------------------------------------------------------

    def _call_center(self) -> DataFrame:
        return self._dimension("call_center", {"closed_date_sk": "cast(null as bigint)", "hours": "'8AM-4PM'"})

    def _catalog_page(self) -> DataFrame:
        return self._dimension(
            "catalog_page",
            {
                "department": "'DEPARTMENT'",
                "catalog_number": "(k - 1) div 108 + 1",
                "catalog_page_number": "(k - 1) % 108 + 1",
                "type": choose("monthly,quarterly,bi-annual", "(k % 3)"),
            },
        )

    def _customer(self) -> DataFrame:
        first, last = choose(FIRST_NAMES, draw(5001, "k", 16)), choose(LAST_NAMES, draw(5002, "k", 16))
        return self._dimension(
            "customer",
            {
                "salutation": choose("Mr.,Mrs.,Ms.,Miss,Dr.,Sir", draw(5003, "k", 6)),
                "first_name": first,
                "last_name": last,
                "preferred_cust_flag": choose("N,Y", draw(5004, "k", 2)),
                "birth_day": f"1 + {draw(5005, 'k', 28)}",
                "birth_month": f"1 + {draw(5006, 'k', 12)}",
                "birth_year": f"1924 + {draw(5007, 'k', 69)}",
                "birth_country": choose(COUNTRIES, draw(5008, "k", 12)),
                "login": "cast(null as string)",
                "email_address": f"concat({first}, '.', {last}, cast(k as string), '@example.com')",
            },
        )

    def _customer_address(self) -> DataFrame:
        return self._dimension(
            "customer_address", {"location_type": choose("apartment,condo,single family", draw(6001, "k", 3))}
        )

    def _customer_demographics(self) -> DataFrame:
        # Every combination once: the digits of the running number in mixed bases.
        return self._dimension(
            "customer_demographics",
            {
                "gender": choose("M,F", "((k - 1) % 2)"),
                "marital_status": choose("M,S,D,W,U", "((k - 1) div 2 % 5)"),
                "education_status": choose(EDUCATION, "((k - 1) div 10 % 7)"),
                "purchase_estimate": "500 + 500 * ((k - 1) div 70 % 20)",
                "credit_rating": choose(RATINGS, "((k - 1) div 1400 % 4)"),
                "dep_count": "(k - 1) div 5600 % 7",
                "dep_employed_count": "(k - 1) div 39200 % 7",
                "dep_college_count": "(k - 1) div 274400 % 7",
            },
        )

    def _date_dim(self) -> DataFrame:
        # k = 0 is the first calendar day.
        days = numbered(self.spark, self.rows["date_dim"], "k", self.parts, 1, 0).selectExpr(
            "k", f"{FIRST_DAY} + cast(k as int) as d"
        )
        quarter = "(year(d) - 1900) * 4 + quarter(d) - 1"
        week = "(k + 1) div 7 + 1"
        holiday = "(month(d) = 12 and day(d) = 25) or (month(d) = 1 and day(d) = 1) or (month(d) = 7 and day(d) = 4)"
        day_before = "d + -1"
        return self._build(
            days,
            "date_dim",
            "k",
            {
                "date_sk": f"{FIRST_DAY_SK} + k",
                "date_id": f"concat('AAAAAAAA', lpad(hex({FIRST_DAY_SK} + k), 8, 'A'))",
                "date": "d",
                "month_seq": "(year(d) - 1900) * 12 + month(d) - 1",
                "week_seq": week,
                "quarter_seq": quarter,
                "year": "year(d)",
                "dow": "dayofweek(d) - 1",
                "moy": "month(d)",
                "dom": "day(d)",
                "qoy": "quarter(d)",
                "fy_year": "year(d)",
                "fy_quarter_seq": quarter,
                "fy_week_seq": week,
                "day_name": choose(DAYS, "(dayofweek(d) - 1)"),
                "quarter_name": "concat(cast(year(d) as string), 'Q', cast(quarter(d) as string))",
                "holiday": f"if({holiday}, 'Y', 'N')",
                "weekend": "if(dayofweek(d) in (1, 7), 'Y', 'N')",
                "following_holiday": f"if({holiday.replace('(d)', f'({day_before})')}, 'Y', 'N')",
                "first_dom": f"{FIRST_DAY_SK} + datediff(trunc(d, 'MM'), {FIRST_DAY})",
                "last_dom": f"{FIRST_DAY_SK} + datediff(last_day(d), {FIRST_DAY})",
                "same_day_ly": f"{FIRST_DAY_SK} + k - 365",
                "same_day_lq": f"{FIRST_DAY_SK} + k - 91",
                "current_day": "'N'",
                "current_week": "'N'",
                "current_month": "'N'",
                "current_quarter": "'N'",
                "current_year": "'N'",
            },
        )

    def _household_demographics(self) -> DataFrame:
        return self._dimension(
            "household_demographics",
            {
                "income_band_sk": "(k - 1) % 20 + 1",
                "buy_potential": choose(BUY_POTENTIAL, "((k - 1) div 20 % 6)"),
                "dep_count": "(k - 1) div 120 % 10",
                "vehicle_count": "(k - 1) div 1200 % 6 - 1",
            },
        )

    def _income_band(self) -> DataFrame:
        return self._dimension(
            "income_band", {"lower_bound": "if(k = 1, 0, (k - 1) * 10000 + 1)", "upper_bound": "k * 10000"}
        )

    def _inventory(self) -> DataFrame:
        items, houses = max(self.rows["item"] // 2, 1), self.rows["warehouse"]
        df = numbered(self.spark, self.rows["inventory"], "k", self.parts, self.least, 0)
        return self._build(
            df,
            "inventory",
            "k",
            {
                "date_sk": f"{FIRST_SALE_SK} + 7 * (k div {items * houses})",
                "item_sk": f"least(k % {items} * 2 + 1, {self.rows['item']}L)",
                "warehouse_sk": f"k div {items} % {houses} + 1",
                "quantity_on_hand": draw(11003, "k", 1001),
            },
        )

    def _item(self) -> DataFrame:
        def named(number: str, tag: int) -> str:
            return f"concat({choose(PLAIN, draw(tag, number, 20))}, ' #', cast({number} as string))"

        brand, group, kind, maker = (draw(12000 + i, "k", n) for i, n in ((1, 1000), (2, 16), (3, 10), (4, 1000)))
        return self._dimension(
            "item",
            {
                "current_price": f"99 + {draw(12005, 'k', 9900)}",
                "wholesale_cost": f"50 + {draw(12006, 'k', 5000)}",
                "brand_id": f"1000001 + {brand}",
                "brand": named(f"({brand})", 12007),
                "class_id": f"1 + {group}",
                "class": named(f"({group})", 12008),
                "category_id": f"1 + {kind}",
                "category": choose(CATEGORIES, f"({kind})"),
                "manufact_id": f"1 + {maker}",
                "manufact": named(f"({maker})", 12009),
                "size": choose(SIZES, draw(12010, "k", 7)),
                "color": choose(COLORS, draw(12011, "k", 16)),
                "units": choose(UNITS, draw(12012, "k", 12)),
                "container": "'Unknown'",
                "product_name": f"concat({choose(PLAIN, draw(12013, 'k', 20))}, cast(k as string))",
            },
        )

    def _promotion(self) -> DataFrame:
        flags = {
            name: choose("N,Y", draw(13100 + i, "k", 2))
            for i, name in enumerate(
                "channel_dmail channel_email channel_catalog channel_tv channel_radio channel_press channel_event "
                "channel_demo discount_active".split()
            )
        }
        return self._dimension("promotion", {"cost": "100000", "response_target": "1", "purpose": "'Unknown'", **flags})

    def _reason(self) -> DataFrame:
        return self._dimension("reason", {"reason_desc": "concat('reason ', cast(k as string))"})

    def _ship_mode(self) -> DataFrame:
        return self._dimension(
            "ship_mode",
            {
                "type": choose(SHIP_TYPES, "((k - 1) % 6)"),
                "code": choose(SHIP_CODES, "((k - 1) div 6 % 4)"),
                "carrier": "concat('CARRIER', cast(k as string))",
            },
        )

    def _store(self) -> DataFrame:
        return self._dimension(
            "store",
            {
                "closed_date_sk": "cast(null as bigint)",
                "store_name": choose(PLAIN, "(k % 20)"),
                "number_employees": f"200 + {draw(18001, 'k', 100)}",
                "floor_space": f"5000000 + {draw(18002, 'k', 5000000)}",
                "hours": choose("8AM-4PM,8AM-8AM,8AM-12AM", "(k % 3)"),
            },
        )

    def _time_dim(self) -> DataFrame:
        return self._dimension(
            "time_dim",
            {
                "time": "k",
                "hour": "k div 3600",
                "minute": "k div 60 % 60",
                "second": "k % 60",
                "am_pm": "if(k < 43200, 'AM', 'PM')",
                "shift": choose("third,first,second", "(k div 28800)"),
                "sub_shift": choose("night,morning,afternoon,evening", "(k div 21600)"),
                "meal_time": "case when k div 3600 between 6 and 8 then 'breakfast' "
                "when k div 3600 between 11 and 13 then 'lunch' when k div 3600 between 17 and 20 then 'dinner' end",
            },
            start=0,
        )

    def _warehouse(self) -> DataFrame:
        return self._dimension("warehouse", {"warehouse_sq_ft": f"50000 + {draw(21001, 'k', 900000)}"})

    def _web_page(self) -> DataFrame:
        return self._dimension(
            "web_page",
            {
                "autogen_flag": choose("N,Y", draw(22001, "k", 2)),
                "url": "'http://www.example.com'",
                "type": choose("general,order,welcome,ad,feedback,protected,dynamic", draw(22002, "k", 7)),
                "char_count": f"100 + {draw(22003, 'k', 8000)}",
            },
        )

    def _web_site(self) -> DataFrame:
        return self._dimension("web_site", {"name": "concat('site_', cast((k - 1) div 6 as string))"})

    # --- sales and returns ------------------------------------------------------------------------

    def _sale_facts(self, df: DataFrame, channel: int, ship: bool) -> DataFrame:
        """Add ticket, item and amounts in cents to rows that carry the sale's number ``s`` (from 0)."""
        items = self.rows["item"]
        step = max(items // (LINES_PER_TICKET + 1), 1)
        amounts = df.selectExpr(
            "*",
            f"s div {LINES_PER_TICKET} + 1 as ticket",
            f"xxhash64({channel}, s) as w",
        ).selectExpr(
            "*",
            # Steps through the items keep an item from occurring twice on a ticket.
            f"1 + ({draw(channel + 1, 'ticket', items)} + s % {LINES_PER_TICKET} * {step}) % {items} as item",
            "1 + (w & 65535) % 100 as quantity",
            "100 + (shiftrightunsigned(w, 16) & 65535) % 9901 as wholesale",
            "100 + (shiftrightunsigned(w, 32) & 255) % 101 as markup",
            "(shiftrightunsigned(w, 40) & 255) % 101 as rebate",
            "(shiftrightunsigned(w, 48) & 15) % 10 as tax_rate",
            "if((shiftrightunsigned(w, 52) & 7) = 0, (shiftrightunsigned(w, 55) & 63) % 51, 0) as coupon_rate",
            "(shiftrightunsigned(w, 55) & 127) % 51 as ship_rate",
        )
        prices = amounts.selectExpr("*", "wholesale * markup div 100 as list").selectExpr(
            "*", "list * (100 - rebate) div 100 as sales"
        )
        totals = prices.selectExpr(
            "*", "sales * quantity as ext_sales", "list * quantity as ext_list", "wholesale * quantity as ext_wholesale"
        ).selectExpr("*", "ext_sales * coupon_rate div 100 as coupon", "ext_list * ship_rate div 100 as shipping")
        paid = totals.selectExpr("*", "ext_sales - coupon as paid").selectExpr("*", "paid * tax_rate div 100 as tax")
        return paid if ship else paid.drop("shipping", "ship_rate")

    def _sale_columns(self, ship: bool) -> dict[str, str]:
        columns = {
            "item_sk": "item",
            "quantity": "quantity",
            "wholesale_cost": "wholesale",
            "list_price": "list",
            "sales_price": "sales",
            "ext_discount_amt": "ext_list - ext_sales",
            "ext_sales_price": "ext_sales",
            "ext_wholesale_cost": "ext_wholesale",
            "ext_list_price": "ext_list",
            "ext_tax": "tax",
            "coupon_amt": "coupon",
            "net_paid": "paid",
            "net_paid_inc_tax": "paid + tax",
            "net_profit": "paid - ext_wholesale",
        }
        if ship:
            columns |= {
                "ext_ship_cost": "shipping",
                "net_paid_inc_ship": "paid + shipping",
                "net_paid_inc_ship_tax": "paid + shipping + tax",
            }
        return columns

    def _return_columns(self) -> dict[str, str]:
        """Amounts of a return in cents; the returned quantity is a share of the sold one."""
        return {
            "item_sk": "item",
            "return_quantity": "returned",
            "return_amt": "amount",
            "return_amount": "amount",
            "return_tax": "amount * tax_rate div 100",
            "return_amt_inc_tax": "amount + amount * tax_rate div 100",
            "fee": "50 + rebate * 90",
            "return_ship_cost": "list * returned div 10",
            "refunded_cash": "amount div 2",
            "reversed_charge": "amount div 4",
            "store_credit": "amount - amount div 2 - amount div 4",
            "account_credit": "amount - amount div 2 - amount div 4",
            "net_loss": "50 + rebate * 90 + list * returned div 10",
        }

    # Columns that belong to the whole ticket; the others are drawn per line.
    TICKET_ENDINGS = ("sold_date_sk", "sold_time_sk", "customer_sk", "cdemo_sk", "hdemo_sk", "addr_sk", "store_sk")

    def _ticket_references(self, table: str) -> dict[str, str]:
        prefix, names = bare_columns(table)
        picked = {}
        for bare in names:
            if bare.endswith(self.TICKET_ENDINGS) and not bare.startswith(("returned_", "return_")):
                picked[bare] = self._default(table, prefix + bare, "I", "ticket")
        return picked

    def _sales(self, table: str, channel: int, number: str, ship: bool) -> DataFrame:
        keys = numbered(self.spark, self.rows[table], "s", self.parts, self.least, 0)
        values = self._ticket_references(table) | self._sale_columns(ship) | {number: "ticket"}
        if ship:
            sold = self._default(table, bare_columns(table)[0] + "sold_date_sk", "I", "ticket")
            values["ship_date_sk"] = f"({sold}) + 2 + {draw(channel + 2, 's', 60)}"
        return self._build(self._sale_facts(keys, channel, ship), table, "s", values)

    def _returns(self, table: str, sales: str, channel: int, number: str) -> DataFrame:
        # Return r belongs to sale r * stride, so no sale is returned twice.
        stride = max(self.rows[sales] // self.rows[table], 1)
        keys = numbered(self.spark, self.rows[table], "r", self.parts, self.least, 0).selectExpr(f"r * {stride} as s")
        facts = self._sale_facts(keys, channel, True).selectExpr(
            "*", f"1 + {draw(channel + 3, 's', 'quantity')} as returned"
        ).selectExpr("*", "sales * returned as amount")
        layout = bare_columns(table)[1]
        values = {c: v for c, v in self._return_columns().items() if c in layout} | {number: "ticket"}
        sold = self._default(sales, bare_columns(sales)[0] + "sold_date_sk", "I", "ticket")
        values["returned_date_sk"] = f"({sold}) + 1 + {draw(channel + 4, 's', 90)}"
        return self._build(facts, table, "s", values)

    def _store_sales(self) -> DataFrame:
        return self._sales("store_sales", 31000, "ticket_number", False)

    def _store_returns(self) -> DataFrame:
        return self._returns("store_returns", "store_sales", 31000, "ticket_number")

    def _catalog_sales(self) -> DataFrame:
        return self._sales("catalog_sales", 32000, "order_number", True)

    def _catalog_returns(self) -> DataFrame:
        return self._returns("catalog_returns", "catalog_sales", 32000, "order_number")

    def _web_sales(self) -> DataFrame:
        return self._sales("web_sales", 33000, "order_number", True)

    def _web_returns(self) -> DataFrame:
        return self._returns("web_returns", "web_sales", 33000, "order_number")
