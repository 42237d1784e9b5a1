import re

import pytest
from hypothesis import HealthCheck, given, settings as options
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daybook.functions.phone import phone_format

# Every layout of the feed, and edge cases.
GOLDEN = {
    "(236)803-8134x9509": "+2368 (038) 134-9509 (Ext: 509)",
    "001-478-744-8501": "+001 (478) 744-8501 (Ext: 501)",
    "(504)273-9020": "(504) 273-9020",
    "307-721-7366x91025": "+30772 (173) 669-1025 (Ext: 025)",
    "406.299.8886": "(406) 299-8886",
    "001-678-237-6444x38797": "+00167823 (764) 443-8797 (Ext: 797)",
    "(634)893-8622x46452": "+63489 (386) 224-6452 (Ext: 452)",
    "+1-477-531-0696": "+1 (477) 531-0696",
    "252-603-0871x8654": "+2526 (030) 871-8654 (Ext: 654)",
    "001-460-588-2792x901": "+001460 (588) 279-2901 (Ext: 901)",
    "+1-691-396-7552x2799": "+1 (691) 396-75522799 (Ext: 2799)",
    "703-908-8764": "(703) 908-8764",
    "+1-966-715-8966x473": "+1 (966) 715-8966473 (Ext: 473)",
    "(497)542-8383x625": "+497 (542) 838-3625 (Ext: 625)",
    "861.252.1070x86182": "+86125 (210) 708-6182 (Ext: 182)",
    "+1-457-656-1134x83635": "+1 (457) 656-113483635 (Ext: 83635)",
    "665.891.8308x989": "+665 (891) 830-8989 (Ext: 989)",
    "2183525490": "(218) 352-5490",
    "627.524.9364x9102": "+6275 (249) 364-9102 (Ext: 102)",
    "768-564-6807x882": "+768 (564) 680-7882 (Ext: 882)",
    "001-437-441-3108x3912": "+0014374 (413) 108-3912 (Ext: 912)",
    "5551234": "5551234",
    "ext": "ext",
    "": "",
    "1234567890": "(123) 456-7890",
    "11234567890": "+1 (123) 456-7890",
    "(123)456-7890x12": "+1 (234) 567-89012 (Ext: 2)",
    "+(541)839-3405": "+( (541) 839-3405 (Ext: 405)",
    "++15418393405": "++1 (541) 839-3405 (Ext: 405)",
    "+44 20 7946 0958": "+44 (207) 946-0958 (Ext: 958)",
}


def formatted(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "phone string")
    return [r[0] for r in df.select(phone_format(F.col("phone"))).collect()]


def expected(text: str) -> str:
    """The same rules, stated over a list of kept characters."""
    kept = "".join(
        c for i, c in enumerate(text)
        if re.match(r"\d", c) or (i > 0 and text[i - 1] == "+")
    )
    size = len(kept)
    if size < 10:
        return text
    if size == 10:
        return "({}) {}-{}".format(kept[:3], kept[3:6], kept[6:])
    if kept[0] == "1":
        tail = f" (Ext: {kept[11:]})" if size > 11 else ""
        return "+1 ({}) {}-{}{}".format(kept[1:4], kept[4:7], kept[7:], tail)
    front, number = kept[: size - 10], kept[size - 10 :]
    return "+{} ({}) {}-{} (Ext: {})".format(
        front, number[:3], number[3:6], number[6:], number[7:]
    )


def test_golden_layouts(spark):
    assert formatted(spark, list(GOLDEN)) == list(GOLDEN.values())


@pytest.mark.parametrize("text", GOLDEN)
def test_the_plain_rules_agree_with_the_golden_layouts(text):
    assert expected(text) == GOLDEN[text]


def test_null_stays_null(spark):
    assert formatted(spark, [None]) == [None]


@options(
    max_examples=15,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(st.lists(st.text("0123456789+()-. x١é", max_size=24), min_size=1, max_size=200))
def test_any_text(spark, texts):
    assert formatted(spark, texts) == [expected(t) for t in texts]
