"""Typing of many text columns at once.

Each step is a projection over the one before, so a text is stripped once and
its first value is cut once, however often the rules for numbers and
categories look at them. Catalyst keeps such steps apart and runs them in one stage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from packetloom.functions.text import (
    MISSING_CATEGORY,
    first_value_sql,
    missing_stripped_sql,
    number_sql,
    quoted,
    short_lower_sql,
    strip_column_sql,
    text_of,
)
from packetloom.operators.distribution import NUMBER_TYPES


def holds_numbers(types: dict[str, str], column: str) -> bool:
    return types.get(column, "").startswith(NUMBER_TYPES)


def parsed_parts(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """For each column i: s{i} (stripped text), m{i} (is missing) and n{i} (number or null).

    A column the frame lacks is null. A column that holds numbers already is
    not parsed; its text would give the same number.
    """
    kept, numbered = [quoted(k) for k in keep], range(len(columns))
    types = dict(df.dtypes)
    numeric = {i for i, c in enumerate(columns) if holds_numbers(types, c)}

    def source(i: int) -> str:
        if columns[i] not in types:
            return f"cast(NULL AS string) AS s{i}"
        if i in numeric:
            return f"nullif(cast({quoted(columns[i])} AS double), double('nan')) AS n{i}"
        return f"{strip_column_sql(text_of(columns[i]))} AS s{i}"

    def parts(i: int) -> list[str]:
        if i in numeric:
            return [f"n{i}", f"n{i} IS NULL AS m{i}", f"{text_of(columns[i])} AS s{i}"]
        return [f"s{i}", f"{missing_stripped_sql(f's{i}', f's{i}')} AS m{i}", f"{first_value_sql(f's{i}')} AS h{i}"]

    # Numbers keep their own column for the text form, which has the type's own spelling.
    originals = [quoted(c) for c in dict.fromkeys(columns[i] for i in sorted(numeric)) if c not in keep]
    stripped = df.selectExpr(*kept, *originals, *[source(i) for i in numbered])
    divided = stripped.selectExpr(*kept, *[p for i in numbered for p in parts(i)])
    shared = [*kept, *[f"s{i}" for i in numbered], *[f"m{i}" for i in numbered]]
    lowered = divided.selectExpr(
        *shared,
        *[f"n{i}" if i in numeric else f"h{i}" for i in numbered],
        *[f"{short_lower_sql(f'h{i}')} AS l{i}" for i in numbered if i not in numeric],
    )
    return lowered.selectExpr(
        *shared, *[f"n{i}" if i in numeric else f"{number_sql(f'h{i}', f'l{i}', f'm{i}')} AS n{i}" for i in numbered]
    )


def category_of(i: int) -> str:
    return f"if(m{i}, '{MISSING_CATEGORY}', s{i})"


def type_columns(df: DataFrame, numeric: Sequence[str], order: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The columns to keep, then the given columns as numbers or categories. Absent columns are null text."""
    numbers = set(numeric)
    outputs = [f"{f'n{i}' if c in numbers else category_of(i)} AS {quoted(c)}" for i, c in enumerate(order)]
    return parsed_parts(df, list(order), keep).selectExpr(*[quoted(k) for k in keep], *outputs)
