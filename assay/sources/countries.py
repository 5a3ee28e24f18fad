"""Country-code set for the ``country_code`` membership rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Fixed values (must equal the reference's set): 245 codes, some withdrawn or reserved.
COUNTRY_CODES = tuple("""
AD AE AF AG AI AL AM AN AO AQ AR AS AT AU AW AZ BA BB BD BE BF BG BH BI BJ BM BN BO BR BS BT BU BV BW BY BZ CA
CC CF CG CH CI CK CL CM CN CO CR CS CU CV CX CY CZ DD DE DJ DK DM DO DZ EC EE EG EH ER ES ET FI FJ FK FM FO FR
FX GA GB GD GE GF GH GI GL GM GN GP GQ GR GS GT GU GW GY HK HM HN HR HT HU ID IE IL IN IO IQ IR IS IT JM JO JP
KE KG KH KI KM KN KP KR KW KY KZ LA LB LC LI LK LR LS LT LU LV LY MA MC MD MG MH ML MM MN MO MP MQ MR MS MT MU
MV MW MX MY MZ NA NC NE NF NG NI NL NO NP NR NT NU NZ OM PA PE PF PG PH PK PL PM PN PR PT PW PY QA RE RO RU RW
SA SB SC SD SE SG SH SI SJ SK SL SM SN SO SR ST SU SV SY SZ TC TD TF TG TH TJ TK TM TN TO TP TR TT TV TW TZ UA
UG UM US UY UZ VA VC VE VG VI VN VU WF WS YD YE YT YU ZA ZM ZR ZW ZZ
""".split())


def country_codes() -> tuple[str, ...]:
    """The suite's codes, sorted; case-sensitive ('NA' is Namibia, not null)."""
    return COUNTRY_CODES


def country_dim(spark: SparkSession, codes: tuple[str, ...] | None = None) -> DataFrame:
    """The code set as a one-column dimension DataFrame (``code``)."""
    schema = T.StructType([T.StructField("code", T.StringType(), False)])
    return spark.createDataFrame([(c,) for c in codes or COUNTRY_CODES], schema)
