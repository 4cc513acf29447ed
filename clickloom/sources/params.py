"""Task parameters: a JSON object of arrays whose first elements count."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The field names of the parameter document.
PARAM_FIELDS = (
    "startDate",
    "endDate",
    "startAge",
    "endAge",
    "professionals",
    "cities",
    "sex",
    "keywords",
    "categoryIds",
    "targetPageFlow",
)


def param(doc: Column, field: str) -> Column:
    """First element of the field's array as text; NULL when missing, empty or broken."""
    return F.get_json_object(doc, f"$.{field}[0]")


def read_task_params(tasks: DataFrame, doc: str = "task_param") -> DataFrame:
    """Replace the parameter document by one text column per field."""
    kept = [F.col(c) for c in tasks.columns if c != doc]
    return tasks.select(*kept, *(param(F.col(doc), f).alias(f) for f in PARAM_FIELDS))


@dataclass(frozen=True)
class TaskParams:
    """The parameters of one task. ``None`` or an empty list means "not given"."""

    start_date: str | None = None
    end_date: str | None = None
    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] = ()
    cities: tuple[str, ...] = ()
    sex: str | None = None
    keywords: tuple[str, ...] = ()
    category_ids: tuple[int, ...] = ()
    page_flow: tuple[int, ...] = ()

    @classmethod
    def from_fields(cls, fields: dict[str, str | None]) -> TaskParams:
        def words(name: str) -> tuple[str, ...]:
            return tuple(w for w in (fields.get(name) or "").split(",") if w)

        def number(name: str) -> int | None:
            return int(fields[name]) if fields.get(name) else None

        return cls(
            start_date=fields.get("startDate"),
            end_date=fields.get("endDate"),
            start_age=number("startAge"),
            end_age=number("endAge"),
            professionals=words("professionals"),
            cities=words("cities"),
            sex=fields.get("sex") or None,
            keywords=words("keywords"),
            category_ids=tuple(map(int, words("categoryIds"))),
            page_flow=tuple(map(int, words("targetPageFlow"))),
        )


def load_params(tasks: DataFrame, task_id: int) -> TaskParams:
    """Parameters of one task: a single row comes to the driver, to shape the plan."""
    row = read_task_params(tasks.where(F.col("task_id") == task_id)).head()
    if row is None:
        raise LookupError(f"no task {task_id}")
    return TaskParams.from_fields(row.asDict())
