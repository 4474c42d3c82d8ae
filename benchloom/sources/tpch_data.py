"""The eight TPC-H tables at any scale factor as lazy DataFrames.

Row counts, key structure, value domains and the derived amounts follow the public specification; the
words are drawn anew. Lines are expanded inside the order partitions, and an order's total and status
are folded over the same per-line expressions, so neither table needs a shuffle or the other one.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from benchloom.operators.conform import LINEITEM_AT_SF1, tpch_row_rules
from benchloom.sources.drawing import bits, choose, draw, finish, money_choice, numbered, output_parts, padded, tasks_for

# The public word lists of the specification.
REGIONS = "AFRICA,AMERICA,ASIA,EUROPE,MIDDLE EAST"
NATIONS = (
    "ALGERIA,ARGENTINA,BRAZIL,CANADA,EGYPT,ETHIOPIA,FRANCE,GERMANY,INDIA,INDONESIA,IRAN,IRAQ,JAPAN,JORDAN,KENYA,"
    "MOROCCO,MOZAMBIQUE,PERU,CHINA,ROMANIA,SAUDI ARABIA,VIETNAM,RUSSIA,UNITED KINGDOM,UNITED STATES"
)
NATION_REGIONS = "0,1,1,1,4,0,3,3,2,2,4,4,2,4,0,0,0,1,2,3,4,2,3,3,1"
SEGMENTS = "AUTOMOBILE,BUILDING,FURNITURE,MACHINERY,HOUSEHOLD"
PRIORITIES = "1-URGENT,2-HIGH,3-MEDIUM,4-NOT SPECIFIED,5-LOW"
INSTRUCTIONS = "DELIVER IN PERSON,COLLECT COD,NONE,TAKE BACK RETURN"
MODES = "REG AIR,AIR,RAIL,SHIP,TRUCK,MAIL,FOB"
TYPE_SIZES = "STANDARD,SMALL,MEDIUM,LARGE,ECONOMY,PROMO"
TYPE_FINISHES = "ANODIZED,BURNISHED,PLATED,POLISHED,BRUSHED"
TYPE_METALS = "TIN,NICKEL,BRASS,STEEL,COPPER"
CONTAINER_SIZES = "SM,LG,MED,JUMBO,WRAP"
CONTAINER_KINDS = "CASE,BOX,BAG,JAR,PKG,PACK,CAN,DRUM"
COLORS = (
    "almond,antique,aquamarine,azure,beige,bisque,black,blanched,blue,blush,brown,burlywood,burnished,chartreuse,"
    "chiffon,chocolate,coral,cornflower,cornsilk,cream,cyan,dark,deep,dim,dodger,drab,firebrick,floral,forest,"
    "frosted,gainsboro,ghost,goldenrod,green,grey,honeydew,hot,indian,ivory,khaki,lace,lavender,lawn,lemon,light,"
    "lime,linen,magenta,maroon,medium,metallic,midnight,mint,misty,moccasin,navajo,navy,olive,orange,orchid,pale,"
    "papaya,peach,peru,pink,plum,powder,puff,purple,red,rose,rosy,royal,saddle,salmon,sandy,seashell,sienna,sky,"
    "slate,smoke,snow,spring,steel,tan,thistle,tomato,turquoise,violet,wheat,white,yellow"
)
# Our own words for comments.
ADVERBS = "quickly,slowly,carefully,blithely,furiously,quietly,boldly,daringly"
ADJECTIVES = "special,regular,final,express,pending,bold,even,ironic,silent,unusual,careful,busy"
NOUNS = "requests,accounts,packages,deposits,foxes,ideas,theodolites,pinto beans,instructions,platelets,asymptotes,dolphins"
VERBS = "sleep,wake,haggle,nag,cajole,detect,integrate,boost,doze,engage,affix,breach"

FIRST_DAY, ORDER_DAYS = "date'1992-01-01'", 2406
TODAY = "date'1995-06-17'"


def row_counts(sf: Decimal) -> dict[str, int]:
    rules = tpch_row_rules(sf)
    return {**rules, "lineitem": base_lines(rules["orders"]) + bumped_blocks(sf, rules["orders"])}


def base_lines(orders: int) -> int:
    """Lines of the first orders before the adjustment: every seven orders have 1 to 7 lines, 28 together."""
    blocks, rest = divmod(orders, 7)
    return 28 * blocks + sum(1 + (blocks + 3 * r) % 7 for r in range(rest))


def bumped_blocks(sf: Decimal, orders: int) -> int:
    """How many blocks of seven orders give their one-line order a second line: reaches the fixed total at scale 1."""
    return LINEITEM_AT_SF1 - base_lines(orders) if sf == 1 else 0


def lines_of(order: str, bumped: int) -> str:
    lines = f"1 + (3 * {order} + {order} div 7) % 7"
    if not bumped:
        return lines
    return f"if((3 * {order} + {order} div 7) % 7 = 0 and {order} div 7 < {bumped}, 2, {lines})"


def retail_cents(part: str) -> str:
    return f"(90000 + {part} div 10 % 20001 + 100 * ({part} % 1000))"


def supplier_of(part: str, which: str, suppliers: int) -> str:
    return f"(({part} + {which} * ({suppliers // 4} + ({part} - 1) div {suppliers})) % {suppliers} + 1)"


def comment(tag: int, key: str) -> str:
    word = f"xxhash64({tag}, {key})"
    return (
        f"concat_ws(' ', {choose(ADVERBS, bits(word, 0, 8, 8))}, {choose(ADJECTIVES, bits(word, 8, 12))}, "
        f"{choose(NOUNS, bits(word, 24, 12))}, {choose(VERBS, bits(word, 40, 12))})"
    )


def address(tag: int, key: str) -> str:
    return f"substr(concat(hex(xxhash64({tag}, {key})), ' ', hex(xxhash64({tag + 1}, {key}))), 1, cast(10 + {draw(tag + 2, key, 23)} as int))"


def phone(tag: int, key: str, nation: str) -> str:
    word = f"xxhash64({tag}, {key})"
    return (
        f"concat(cast({nation} + 10 as string), '-', cast(100 + {bits(word, 0, 900)} as string), '-', "
        f"cast(100 + {bits(word, 16, 900)} as string), '-', cast(1000 + {bits(word, 32, 9000)} as string))"
    )


# Of each 32 order keys the first eight are used.
ORDER_COLUMNS = (
    "o div 8 * 32 + o % 8 + 1 as orderkey",
    f"{FIRST_DAY} + cast({draw(170, 'o', ORDER_DAYS)} as int) as day",
)


class Tpch:
    """Generator for one scale factor. Each method is one table."""

    def __init__(self, spark: SparkSession, sf: Decimal | str | int, parts: int | None = None):
        self.spark, self.sf, self.parts = spark, Decimal(str(sf)), parts
        if self.sf <= 0:
            raise ValueError("the scale factor must be positive")
        self.rows = row_counts(self.sf)
        self.least = output_parts(self.sf)
        self.suppliers = max(self.rows["supplier"], 1)
        self.stock = max(self.rows["part"], 1)

    def _keys(self, table: str, key: str, start: int = 1) -> DataFrame:
        small = table in ("region", "nation")
        return numbered(
            self.spark, self.rows[table], key, 1 if small else self.parts, 1 if small else self.least, start
        )

    def region(self) -> DataFrame:
        return finish(
            self._keys("region", "k", 0),
            "tpch",
            "region",
            {"r_regionkey": "k", "r_name": choose(REGIONS, "k"), "r_comment": comment(110, "k")},
        )

    def nation(self) -> DataFrame:
        return finish(
            self._keys("nation", "k", 0),
            "tpch",
            "nation",
            {
                "n_nationkey": "k",
                "n_name": choose(NATIONS, "k"),
                "n_regionkey": choose(NATION_REGIONS, "k"),
                "n_comment": comment(120, "k"),
            },
        )

    def supplier(self) -> DataFrame:
        keys = self._keys("supplier", "k").selectExpr("k", f"{draw(130, 'k', 25)} as nation")
        complaint = f"concat('Customer ', {choose(ADVERBS, draw(131, 'k', 8))}, ' Complaints')"
        return finish(
            keys,
            "tpch",
            "supplier",
            {
                "s_suppkey": "k",
                "s_name": f"concat('Supplier#', {padded('k', 9)})",
                "s_address": address(132, "k"),
                "s_nationkey": "nation",
                "s_phone": phone(135, "k", "nation"),
                "s_acctbal": f"{draw(136, 'k', 1099999)} - 99999",
                "s_comment": f"if({draw(137, 'k', 2000)} = 0, {complaint}, {comment(138, 'k')})",
            },
        )

    def customer(self) -> DataFrame:
        keys = self._keys("customer", "k").selectExpr("k", f"{draw(140, 'k', 25)} as nation")
        return finish(
            keys,
            "tpch",
            "customer",
            {
                "c_custkey": "k",
                "c_name": f"concat('Customer#', {padded('k', 9)})",
                "c_address": address(141, "k"),
                "c_nationkey": "nation",
                "c_phone": phone(144, "k", "nation"),
                "c_acctbal": f"{draw(145, 'k', 1099999)} - 99999",
                "c_mktsegment": choose(SEGMENTS, draw(146, "k", 5)),
                "c_comment": comment(147, "k"),
            },
        )

    def part(self) -> DataFrame:
        keys = self._keys("part", "k").selectExpr("k", "xxhash64(150, k) as w", "xxhash64(151, k) as v")
        # Five different colors: steps of 17 in a list of 92 never meet within five.
        colors = ", ".join(choose(COLORS, f"(({bits('w', 0, 92)} + {17 * i}) % 92)") for i in range(5))
        return finish(
            keys,
            "tpch",
            "part",
            {
                "p_partkey": "k",
                "p_name": f"concat_ws(' ', {colors})",
                "p_mfgr": f"concat('Manufacturer#', cast(1 + {bits('w', 16, 5)} as string))",
                "p_brand": f"concat('Brand#', cast(1 + {bits('w', 16, 5)} as string), cast(1 + {bits('w', 32, 5)} as string))",
                "p_type": f"concat_ws(' ', {choose(TYPE_SIZES, bits('v', 0, 6))}, {choose(TYPE_FINISHES, bits('v', 16, 5))}, "
                f"{choose(TYPE_METALS, bits('v', 32, 5))})",
                "p_size": f"1 + {bits('w', 48, 50)}",
                "p_container": f"concat_ws(' ', {choose(CONTAINER_SIZES, bits('v', 48, 5, 8))}, "
                f"{choose(CONTAINER_KINDS, bits('v', 56, 8, 8))})",
                "p_retailprice": retail_cents("k"),
                "p_comment": comment(152, "k"),
            },
        )

    def partsupp(self) -> DataFrame:
        keys = self._keys("part", "k").selectExpr("k", "explode(array(0L, 1L, 2L, 3L)) as i")
        return finish(
            keys,
            "tpch",
            "partsupp",
            {
                "ps_partkey": "k",
                "ps_suppkey": supplier_of("k", "i", self.suppliers),
                "ps_availqty": f"1 + {draw(160, 'k, i', 9999)}",
                "ps_supplycost": f"100 + {draw(161, 'k, i', 99901)}",
                "ps_comment": comment(162, "k, i"),
            },
        )

    # Line values as functions of the order index ``o`` and the line number ``i``, with two drawn words.
    def _part_of(self, word: str) -> str:
        return f"(1 + pmod({word}, {self.stock}))"

    @staticmethod
    def _quantity(other: str) -> str:
        return f"(1 + {bits(other, 0, 50, 14)})"

    @staticmethod
    def _discount(other: str) -> str:
        return bits(other, 14, 11, 10)

    @staticmethod
    def _tax(other: str) -> str:
        return bits(other, 24, 9, 8)

    @staticmethod
    def _ship_days(other: str) -> str:
        return f"(1 + {bits(other, 32, 121, 12)})"

    def _orders(self) -> DataFrame:
        count = self.rows["orders"]
        bumped = bumped_blocks(self.sf, count)
        orders = self.spark.range(0, count, 1, tasks_for(self.spark, count, self.parts, self.least))
        return orders.selectExpr(
            "id as o",
            f"cast({lines_of('id', bumped)} as int) as lines",
        ).selectExpr("o", *ORDER_COLUMNS, "lines")

    def orders(self) -> DataFrame:
        buyers = max(self.rows["customer"] - self.rows["customer"] // 3, 1)
        # The keys come from a range, which Spark knows to be clustered by them: summing the expanded lines
        # per order needs no exchange. Day and number of lines follow from the key again.
        amount = (
            f"{self._quantity('v')} * {retail_cents(self._part_of('w'))} * (100 - {self._discount('v')}) "
            f"* (100 + {self._tax('v')}) div 10000"
        )
        folded = (
            self._orders()
            .selectExpr("o", "day", "explode(sequence(1, lines)) as i")
            .selectExpr("o", "day", "xxhash64(180, o, i) as w", "xxhash64(181, o, i) as v")
            .groupBy("o")
            .agg(
                F.sum(F.expr(amount)).alias("cents"),
                F.count_if(F.expr(f"date_add(day, cast({self._ship_days('v')} as int)) > {TODAY}")).alias("open"),
                F.count("*").alias("lines"),
            )
            .selectExpr("*", *ORDER_COLUMNS)
        )
        return finish(
            folded,
            "tpch",
            "orders",
            {
                "o_orderkey": "orderkey",
                # Every third customer places no order.
                "o_custkey": f"1 + {draw(171, 'o', buyers)} + {draw(171, 'o', buyers)} div 2",
                "o_orderstatus": "case open when 0 then 'F' when lines then 'O' else 'P' end",
                "o_totalprice": "cents",
                "o_orderdate": "day",
                "o_orderpriority": choose(PRIORITIES, draw(172, "o", 5)),
                "o_clerk": f"concat('Clerk#', {padded(f'1 + {draw(173, chr(111), max(int(1000 * self.sf), 1))}', 9)})",
                "o_shippriority": "0",
                "o_comment": comment(174, "o"),
            },
        )

    def lineitem(self) -> DataFrame:
        lines = (
            self._orders()
            .selectExpr("o", "orderkey", "day", "explode(sequence(1, lines)) as i")
            .selectExpr("*", "xxhash64(180, o, i) as w", "xxhash64(181, o, i) as v")
            .selectExpr("*", f"{self._part_of('w')} as part", f"day + cast({self._ship_days('v')} as int) as shipped")
            .selectExpr("*", f"shipped + cast(1 + {bits('v', 50, 30, 10)} as int) as received")
        )
        return finish(
            lines,
            "tpch",
            "lineitem",
            {
                "l_orderkey": "orderkey",
                "l_partkey": "part",
                "l_suppkey": supplier_of("part", "(shiftrightunsigned(w, 62) & 3)", self.suppliers),
                "l_linenumber": "i",
                "l_quantity": money_choice(f"({self._quantity('v')} - 1)", 100, 5000, 100),
                "l_extendedprice": f"{self._quantity('v')} * {retail_cents('part')}",
                "l_discount": money_choice(self._discount("v"), 0, 10),
                "l_tax": money_choice(self._tax("v"), 0, 8),
                "l_returnflag": f"case when received > {TODAY} then 'N' when w % 2 = 0 then 'R' else 'A' end",
                "l_linestatus": f"if(shipped > {TODAY}, 'O', 'F')",
                "l_shipdate": "shipped",
                "l_commitdate": f"day + cast(30 + {bits('v', 44, 61, 6)} as int)",
                "l_receiptdate": "received",
                "l_shipinstruct": choose(INSTRUCTIONS, bits("v", 60, 4, 2)),
                "l_shipmode": choose(MODES, bits("w", 40, 7)),
                "l_comment": comment(182, "o, i"),
            },
            exact=("l_quantity", "l_discount", "l_tax"),
        )

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name)() for name in self.rows if name != "lineitem"} | {"lineitem": self.lineitem()}

