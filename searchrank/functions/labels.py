"""Relevance labels derived from clicks and bookings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Graded relevance of a booked / clicked-only / other row,
# and the training weight factors (booking x5 plus click x1).
GRADE_BOOKED = 5
GRADE_CLICKED = 1
GRADE_NONE = 0
WEIGHT_BOOKING = 5
WEIGHT_CLICK = 1


def grade_expr(book: str = "booking_bool", click: str = "click_bool") -> Column:
    """5 when booked, 1 when clicked but not booked, else 0."""
    return (F.when(F.col(book) == 1, F.lit(GRADE_BOOKED))
             .when(F.col(click) == 1, F.lit(GRADE_CLICKED))
             .otherwise(F.lit(GRADE_NONE)))


def relevance_grade(df: DataFrame, book: str = "booking_bool", click: str = "click_bool",
                    out: str = "relevance_grade") -> DataFrame:
    return df.withColumn(out, grade_expr(book, click))


def weight_expr(book: str = "booking_bool", click: str = "click_bool") -> Column:
    """5 * booking + click: a clicked booking weighs 6."""
    return F.col(book) * WEIGHT_BOOKING + F.col(click) * WEIGHT_CLICK


def relevance_weight(df: DataFrame, book: str = "booking_bool", click: str = "click_bool",
                     out: str = "weight") -> DataFrame:
    return df.withColumn(out, weight_expr(book, click))
