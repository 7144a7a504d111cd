"""Task parameters: JSON text to typed filter settings."""

import datetime as dt
from dataclasses import dataclass, replace
from typing import Optional

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.functions.text import split_csv
from clickflow.functions.times import as_date

# Parameter names in the task JSON. The last one belongs to page conversion.
START_DATE = "startDate"
END_DATE = "endDate"
START_AGE = "startAge"
END_AGE = "endAge"
PROFESSIONALS = "professionals"
CITIES = "cities"
SEX = "sex"
KEYWORDS = "keywords"
CATEGORY_IDS = "categoryIds"
TARGET_PAGE_FLOW = "targetPageFlow"

NAMES = (
    START_DATE,
    END_DATE,
    START_AGE,
    END_AGE,
    PROFESSIONALS,
    CITIES,
    SEX,
    KEYWORDS,
    CATEGORY_IDS,
    TARGET_PAGE_FLOW,
)


def page_hops(flow) -> list:
    """(page, next page) for each step of a flow; a flow of no use raises."""
    pages = [int(page) for page in flow]
    if len(pages) < 2 or len(set(pages)) != len(pages):
        raise ValueError("a page flow needs two or more different pages")
    return list(zip(pages, pages[1:]))


@dataclass(frozen=True)
class TaskParams:
    """One task's settings; None means the condition is not set.

    The age range applies only when both bounds are set.
    """

    start_date: Optional[dt.date] = None
    end_date: Optional[dt.date] = None
    start_age: Optional[int] = None
    end_age: Optional[int] = None
    professionals: Optional[tuple] = None
    cities: Optional[tuple] = None
    sex: Optional[str] = None
    keywords: Optional[tuple] = None
    category_ids: Optional[tuple] = None
    page_flow: Optional[tuple] = None

    @classmethod
    def from_texts(cls, texts):
        """From a mapping of parameter name to text; missing or empty text is not set."""
        text = {name: texts.get(name) or None for name in NAMES}
        flow = split_csv(text[TARGET_PAGE_FLOW])
        if flow is not None:
            page_hops(flow)
        return cls(
            start_date=as_date(text[START_DATE]),
            end_date=as_date(text[END_DATE]),
            start_age=None if text[START_AGE] is None else int(text[START_AGE]),
            end_age=None if text[END_AGE] is None else int(text[END_AGE]),
            professionals=split_csv(text[PROFESSIONALS]),
            cities=split_csv(text[CITIES]),
            sex=text[SEX],
            keywords=split_csv(text[KEYWORDS]),
            category_ids=split_csv(text[CATEGORY_IDS]),
            page_flow=None if flow is None else tuple(int(page) for page in flow),
        )

    def with_(self, **changes):
        return replace(self, **changes)


def parse_task_param(tasks: DataFrame) -> DataFrame:
    """``tasks`` with one text column per parameter: element 0 of its JSON array."""
    schema = ", ".join(f"{name} array<string>" for name in NAMES)
    parsed = F.from_json("task_param", schema)
    return tasks.select("*", *[F.get(parsed[name], 0).alias(name) for name in NAMES])


def task_params(tasks: DataFrame, task_id: int) -> TaskParams:
    """Settings of one task; a missing task raises. Reads a single control row."""
    row = parse_task_param(tasks.filter(F.col("id") == task_id)).select(*NAMES).first()
    if row is None:
        raise LookupError(f"no task with id {task_id}")
    return TaskParams.from_texts(row.asDict())


def task_id_from_args(args) -> Optional[int]:
    """Task id from an argument list; None if missing or malformed."""
    try:
        return int(args[0])
    except (TypeError, ValueError, IndexError):
        return None
