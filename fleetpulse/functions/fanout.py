"""Users' own functions of none to many rows for a row: table functions and a lateral join."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, udtf
from pyspark.sql.types import IntegerType, StringType, StructType


class SplitText:
    """The pieces of a text between separators, without empty ones at the end.

    The columns follow from the arguments: ``name`` for the piece and, if ``numbered``, its place in the text from 0.
    A text of separators only and a null one have no pieces; an empty text is one empty piece.
    """

    @staticmethod
    def analyze(text: AnalyzeArgument, separator: AnalyzeArgument, name: AnalyzeArgument, numbered: AnalyzeArgument) -> AnalyzeResult:
        if not isinstance(text.dataType, StringType):
            raise ValueError(f"text must be a string, not {text.dataType.simpleString()}")
        if not name.isConstantExpression or not separator.value:
            raise ValueError("separator and name must be constants")
        schema = StructType().add(name.value, StringType())
        return AnalyzeResult(schema.add("place", IntegerType()) if numbered.value else schema)

    def eval(self, text: str | None, separator: str, name: str, numbered: bool) -> Iterator[tuple]:
        if text is None:
            return
        pieces = text.split(separator)
        while len(pieces) > 1 and not pieces[-1]:
            pieces.pop()
        if text and pieces == [""]:
            return
        for place, piece in enumerate(pieces):
            yield (piece, place) if numbered else (piece,)


split_text = udtf(SplitText, useArrow=True)


def fan_out(df: DataFrame, function, *arguments: Column) -> DataFrame:
    """Each row with each of the rows that a table function makes of it; rows of which it makes none go.

    Arguments that are columns of ``df`` are given as ``F.col(name).outer()``.
    """
    return df.lateralJoin(function(*arguments))


def split_words(df: DataFrame, text: str, word: str = "word") -> DataFrame:
    """``words.explode_words`` by a table function."""
    split = fan_out(df, split_text, F.col(text).outer(), F.lit(" "), F.lit(word), F.lit(False))
    return split.select(*[c for c in df.columns if c != text], word)
