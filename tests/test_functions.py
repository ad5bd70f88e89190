from datetime import datetime

import pytest
from pyspark.sql import functions as F

from landfall.functions import (
    at_pos,
    batch_position_id,
    blank_to_null,
    cast_fault,
    diff0,
    diff_text,
    differs,
    digits_to_long,
    has_date_prefix,
    in_window,
    is_blank,
    is_datetime_text,
    map_code,
    map_label,
    normalize_biz_date,
    not_in_domain,
    null_safe_ne,
    num0,
    parse_biz_date,
    position_overflow,
    rate_pct,
    resolve_biz_date,
    safe_cast,
    technical_id,
)


def one(rows, ddl, data, column):
    return [r[0] for r in rows(ddl, [(d,) if not isinstance(d, tuple) else d for d in data], column)]


def test_blank_means_spaces_only(rows, spark):
    texts = [None, "", "   ", "\t", " a "]
    assert one(rows, "c string", texts, is_blank("c")) == [True, True, True, False, False]
    assert one(rows, "c string", texts, blank_to_null("c")) == [None, None, None, "\t", "a"]


def test_time_shapes(rows, spark):
    texts = ["2024-01-02 03:04", "2024-01-02 03:04:05", "2024-01-02", "2026-99-99 10:00", None, "2024-01-02T03:04:05"]
    assert one(rows, "c string", texts, is_datetime_text("c")) == [True, True, False, True, False, False]
    assert one(rows, "c string", texts, is_datetime_text("c", strict=True)) == [True, True, False, False, False, False]
    assert one(rows, "c string", texts, has_date_prefix("c")) == [True, True, False, True, False, False]
    assert one(rows, "c string", texts, has_date_prefix("c", strict=True)) == [True, True, False, False, False, False]


def test_null_is_blank_for_metadata_and_outside_any_domain(rows, spark):
    texts = [None, "a", "b"]
    assert one(rows, "c string", texts, differs("c", "a")) == [True, False, True]
    assert one(rows, "c string", texts, not_in_domain("c", ["a"])) == [True, False, True]
    pairs = [(None, None), (1, None), (1, 1), (1, 2)]
    assert one(rows, "a int, b int", pairs, null_safe_ne("a", "b")) == [False, True, False, True]


def test_labels_pass_unknown_values_through(rows, spark):
    assert one(rows, "c string", ["x", "y", None], map_label("c", {"x": "X"})) == ["X", "y", None]
    assert one(rows, "c bigint", [0, 7, None], map_code("c", {0: "zero"})) == ["zero", "7", None]


def test_differences_of_a_childless_row_are_zero(rows, spark):
    data = [(None, None), (5, None), (None, 3), (5, 3)]
    assert one(rows, "a bigint, b bigint", data, diff0("a", "b")) == ["0", "5", "-3", "2"]


def test_technical_id(rows, spark):
    data = [(None, 9, None), (0, 9, 90), (0, 9, None)]
    assert one(rows, "p int, a bigint, b bigint", data, technical_id("p", "a", "b")) == [-9, 90, None]


def test_position_id_never_truncates(rows, spark):
    positions = [0, 9_999_998, 9_999_999]
    got = one(rows, "p bigint", positions, batch_position_id("2024-01-31", "p"))
    assert got == [202401310000001, 202401319999999, None]
    assert one(rows, "p bigint", positions, position_overflow("p")) == [False, False, True]
    wide = one(rows, "p bigint", positions, batch_position_id("2024-01-31", "p", 11))
    assert len(set(wide)) == 3 and None not in wide


def test_casts_report_what_they_lose(rows, spark):
    texts = ["12", " 12 ", "12.0", "x", "", None]
    assert one(rows, "c string", texts, safe_cast("c", "bigint")) == [12, 12, None, None, None, None]
    assert one(rows, "c string", texts, cast_fault("c", "bigint")) == [False, False, True, True, False, False]
    assert one(rows, "c string", [*texts, "9" * 30], digits_to_long("c")) == [12, 12, None, None, None, None, None]
    assert one(rows, "c string", ["7", " ", None], num0("c")) == [7, 0, 0]
    assert str(one(rows, "c double", [1.005], F.col("c").cast("decimal(12,2)"))[0]) in ("1.01", "1.00")


def test_position_outside_the_array_is_null(rows, spark):
    assert one(rows, "a array<string>, p int", [(["x"], 0), (["x"], 1), (None, 0)], at_pos("a", "p")) == ["x", None, None]


def test_rate_and_difference_text(rows, spark):
    assert one(rows, "n bigint, d bigint", [(1, 3), (1, 0)], rate_pct("n", "d")) == [33.3333, None]
    data = [(3441, 3429), (5, 5), (5, 0), (0, 8), (None, 1), (3, -4)]
    got = one(rows, "n bigint, o bigint", data, diff_text("n", "o"))
    assert got == ["+12（0.35%）", "0", "+5", "-8（100.00%）", None, "+7（175.00%）"]


def test_business_date():
    assert parse_biz_date("20260903") == parse_biz_date(" 2026-09-03 ") == "2026-09-03"
    for bad in ("2026-02-30", "2026/09/03", "x"):
        with pytest.raises(ValueError):
            parse_biz_date(bad)
    now = datetime(2026, 9, 4)
    assert resolve_biz_date({"biz_date": "20260901", "bizdate": "20260902"}, "20260903", now, True) == "2026-09-01"
    assert resolve_biz_date({"biz_date": " ", "bizdate": "20260902"}, "20260903", now, True) == "2026-09-02"
    assert resolve_biz_date(None, "20260903", now, True) == "2026-09-03"
    assert resolve_biz_date(None, None, now, False) == "2026-09-04"
    with pytest.raises(ValueError):
        resolve_biz_date({}, "", now, True)


def test_business_date_column(rows, spark):
    texts = ["20260903", "2026-09-03", "2026-02-30", "20260230", " ", None, "2026-9-3"]
    assert one(rows, "c string", texts, normalize_biz_date("c")) == ["2026-09-03"] * 2 + [None] * 5


def test_window_edges(rows, spark):
    ts = F.col("c").cast("timestamp_ntz")
    edges = ["2024-01-31 00:00:00", "2024-01-30 23:59:59", "2024-04-29 23:59:59.5", "2024-04-30 00:00:00"]
    assert one(rows, "c string", edges, in_window(ts, "2024-04-29", 90)) == [True, False, True, False]
    closed = ["2024-01-06 00:00:00", "2024-01-05 23:59:59", "2024-01-20 23:59:59", "2024-01-20 23:59:59.5"]
    assert one(rows, "c string", closed, in_window(ts, "2024-01-20", 15, closed=True)) == [True, False, True, False]
