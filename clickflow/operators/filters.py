"""Date range on actions and the task's conditions on sessions."""

import re
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.functions.text import any_of, is_not_empty
from clickflow.params import TaskParams

# Column that holds a text date of the source, ISO, beside the typed one.
DATE_TEXT = "date_text"


def date_range(actions: DataFrame, params: TaskParams) -> DataFrame:
    """Actions from start to end date, both included; a missing end leaves that side open.

    Where the source's date is text, see ``DATE_TEXT``, its ISO form is compared as well, as a
    scan can skip by a column but not by a cast of it.
    """
    columns = ["date", *(name for name in (DATE_TEXT,) if name in actions.columns)]
    for name in columns:
        form = str if name == DATE_TEXT else (lambda day: day)
        if params.start_date is not None:
            actions = actions.filter(F.col(name) >= F.lit(form(params.start_date)))
        if params.end_date is not None:
            actions = actions.filter(F.col(name) <= F.lit(form(params.end_date)))
    return actions


def user_conditions(params: TaskParams) -> list:
    """Conditions on the user's columns; a condition that is not set is left out."""
    conditions = []
    if params.start_age is not None and params.end_age is not None:
        conditions.append(F.col("age").between(params.start_age, params.end_age))
    if params.professionals is not None:
        conditions.append(any_of(F.col("professional"), params.professionals))
    if params.cities is not None:
        conditions.append(any_of(F.col("city"), params.cities))
    if params.sex is not None:
        conditions.append(F.col("sex") == params.sex)
    return conditions


def searched_any(params: TaskParams) -> Column:
    """Action-level test: this action searched one of the task's keywords."""
    return any_of(F.col("search_keyword"), params.keywords)


def category_ids(params: TaskParams) -> list:
    """The task's categories that are numbers; no other text equals a category's id."""
    return [int(text) for text in params.category_ids if re.fullmatch("0|-?[1-9][0-9]*", text)]


def clicked_any(params: TaskParams) -> Column:
    """Action-level test: this action clicked one of the task's categories."""
    ids = category_ids(params)
    return F.col("click_category_id").isin(ids) if ids else F.lit(False)


def session_conditions(params: TaskParams) -> list:
    """All conditions on sessions that carry comma lists of keywords and categories."""
    conditions = user_conditions(params)
    if params.keywords is not None:
        conditions.append(any_of(F.col("search_keywords"), params.keywords))
    if params.category_ids is not None:
        conditions.append(any_of(F.col("click_category_ids"), params.category_ids))
    return conditions


def keep(df: DataFrame, conditions: list) -> DataFrame:
    """Rows that meet every condition; with none set all rows pass, null never does."""
    return df.filter(reduce(and_, conditions)) if conditions else df


def filter_sessions(sessions: DataFrame, params: TaskParams) -> DataFrame:
    return keep(sessions, session_conditions(params))


def clicks(actions: DataFrame) -> DataFrame:
    return actions.filter(F.col("click_category_id").isNotNull())


def orders(actions: DataFrame) -> DataFrame:
    return actions.filter(is_not_empty(F.col("order_category_ids")))


def pays(actions: DataFrame) -> DataFrame:
    return actions.filter(is_not_empty(F.col("pay_category_ids")))
