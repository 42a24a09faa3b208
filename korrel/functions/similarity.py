"""Similarities in [0, 1] of two columns: 1 if both are empty or equal, 0 if one is empty."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import tokens


def guarded(a: Column, b: Column, value: Column) -> Column:
    """1 for equal texts, 0 where one is empty, else the value."""
    # branches are evaluated in order, so equal and empty texts cost no distance
    return F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0).otherwise(value)


def edit(a: Column, b: Column) -> Column:
    """1 - Levenshtein distance / length of the longer text."""
    return guarded(a, b, 1.0 - F.levenshtein(a, b) / F.greatest(F.char_length(a), F.char_length(b)))


def in_order(x: Column) -> Column:
    """The words of a cleaned text in sorted order, repeats kept, as a text."""
    return F.array_join(F.sort_array(tokens(x)), " ")


def token_sort(a: Column, b: Column) -> Column:
    """Edit similarity of the sorted words, repeats kept."""
    return guarded(a, b, edit(in_order(a), in_order(b)))


def sorted_sets(x: Column, y: Column) -> Column:
    """``token_set`` of two sorted arrays of distinct words; what is common or left of them stays in order."""
    both = F.array_join(F.array_intersect(x, y), " ")
    one = F.trim(F.concat_ws(" ", both, F.array_join(F.array_except(x, y), " ")))
    two = F.trim(F.concat_ws(" ", both, F.array_join(F.array_except(y, x), " ")))
    return F.greatest(edit(both, one), edit(both, two), edit(one, two))


def token_set(a: Column, b: Column) -> Column:
    """Best edit similarity among the common words and the common words followed by either side's own."""
    return guarded(a, b, sorted_sets(F.sort_array(F.array_distinct(tokens(a))), F.sort_array(F.array_distinct(tokens(b)))))


def jaccard(x: Column, y: Column) -> Column:
    """Jaccard similarity of two arrays of distinct values."""
    both = F.size(F.array_intersect(x, y))
    value = both / (F.size(x) + F.size(y) - both)
    return F.when((F.size(x) == 0) & (F.size(y) == 0), 1.0).when((F.size(x) == 0) | (F.size(y) == 0), 0.0).otherwise(value)
