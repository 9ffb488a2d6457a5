"""JSON documents that hold a map of numbers, and result documents."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def number_map(text: Column) -> Column:
    """A JSON object as ``map<string,double>``. A malformed document stops the job."""
    return F.from_json(text, "map<string,double>", {"mode": "FAILFAST"})


def map_total(numbers: Column) -> Column:
    """The sum of a map's values; an empty map gives 0.

    Of a member given more than once the last value counts. A member without a
    number stops the job, as a malformed document does.
    """
    keys = F.map_keys(numbers)
    last = F.filter(
        F.map_entries(numbers), lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), e["key"])
    )
    values = F.when(
        F.size(F.array_distinct(keys)) < F.size(keys), F.transform(last, lambda e: e["value"])
    ).otherwise(F.map_values(numbers))
    missing = F.raise_error(F.lit("a member of the document has no number")).cast("double")
    return F.aggregate(values, F.lit(0.0), lambda total, value: total + F.coalesce(value, missing))


def result_document(**values: Column) -> Column:
    """A JSON object with the given members."""
    return F.to_json(F.struct(*[value.alias(name) for name, value in values.items()]))


def text_document(**values: Column) -> Column:
    """A JSON object whose members are all written as strings."""
    return result_document(**{name: value.cast("string") for name, value in values.items()})
