"""Content contracts of a source and its translation, as boolean columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def extractive(passage: Column, answers: Column) -> Column:
    """Each answer is a part of the passage."""
    return F.forall(answers, lambda a: F.contains(passage, a))


def same_length(source: Column, translated: Column) -> Column:
    """Lists of one length; an empty list stays empty."""
    return F.size(source) == F.size(translated)


def blanks(text: Column, mark: str = "_") -> Column:
    return ((F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))) / len(mark)).cast("long")


def one_blank(text: Column, mark: str = "_") -> Column:
    return blanks(text, mark) == 1


def numbers_kept(source: Column, translated: Column) -> Column:
    """Items that are numbers or dates are the same, byte by byte."""
    return F.forall(F.zip_with(source, translated, lambda a, b: ~F.coalesce(a.rlike(r"^[0-9][0-9.,:/%-]*$"), F.lit(False)) | a.eqNullSafe(b)), lambda x: x)


def same_lines(source: Column, translated: Column) -> Column:
    """As many lines, and the last one verbatim where it starts with ####."""
    a, b = F.split(source, "\n", -1), F.split(translated, "\n", -1)
    last = F.element_at(a, -1)
    return (F.size(a) == F.size(b)) & (~F.startswith(last, F.lit("####")) | (last == F.element_at(b, -1)))


def options_kept(text: Column, labels: str = "ABCD") -> Column:
    """The labels (A), (B) ... all appear."""
    out = F.lit(True)
    for x in labels:
        out = out & F.contains(text, F.lit(f"({x})"))
    return out


def answer_offset(passage: Column, answer: Column) -> Column:
    """The place of an answer in its passage from 0, or -1."""
    return (F.position(answer, passage) - 1).cast("long")
