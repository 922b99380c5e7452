"""Vote counts and ratios by party, gender and district."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame

from plenary.operators.aggregates import attach_counts, crosstab, group_counts, with_ratios
from plenary.operators.filters import drop_incomplete
from plenary.operators.index import materialize
from plenary.operators.joins import attach_members
from plenary.operators.project import trim_names


def member_votes(votes: DataFrame, members: DataFrame, on: str | Sequence[str],
                 required: Sequence[str]) -> DataFrame:
    """Votes with member attributes, rows lacking any required column dropped."""
    return drop_incomplete(attach_members(trim_names(votes), trim_names(members), on), required)


def vote_counts(votes: DataFrame, bill: str, attributes: Sequence[str]) -> DataFrame:
    """(bill, attribute, value, n): a bill's votes by every value of every attribute, in one aggregation."""
    return group_counts(votes, bill, attributes)


def vote_summary(votes: DataFrame, bill: str, attributes: Sequence[str], details: Sequence[str],
                 form: Callable[[Column], Column] | None = None) -> DataFrame:
    """Every vote with its bill's counts, one map from value to count per attribute (`party_counts`, …).

    All values are kept; picking columns out of the maps, or writing them as text, is the caller's `form`. The votes
    are worked out once and stored with the columns that are needed, then read to count and for their details.
    """
    stored = materialize(votes.select(bill, *dict.fromkeys([*attributes, *details])))
    return attach_counts(stored.select(bill, *details), vote_counts(stored, bill, attributes), bill, attributes, form)


def result_shares(votes: DataFrame, groups: Sequence[str], result: str, results: Sequence) -> DataFrame:
    """Votes per result and their share of the group: by bill and party, or by any other attribute."""
    return with_ratios(crosstab(votes, list(groups), result, results), results)
