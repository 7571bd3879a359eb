"""Column-name and file-name helpers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Name marks of covariates, by origin (reanalysis, satellite, blended rain).
COVARIATE_MARKS = ("e5_", "g_", "c_")
# Fixed value: the variable sits between the first two dots of an archive file name.
VARIABLE_IN_FILE_NAME = r"(?<=\.)[^.]+"


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def prefix(df: DataFrame, mark: str, keep: Iterable[str] = ()) -> DataFrame:
    """Put ``mark`` before every name except those in ``keep``."""
    keep = set(keep)
    return df.toDF(*[c if c in keep else mark + c for c in df.columns])


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def suffix_clashes(left: DataFrame, right: DataFrame, on: Iterable[str], marks: tuple[str, str]):
    """Rename columns both sides share (join keys aside) so that a join keeps both."""
    clash = (set(left.columns) & set(right.columns)) - set(on)
    return (left.withColumnsRenamed({c: c + marks[0] for c in clash}),
            right.withColumnsRenamed({c: c + marks[1] for c in clash}))


def covariates(columns: Iterable[str], extra: Iterable[str] = ("month", "hour"),
               marks: tuple[str, ...] = COVARIATE_MARKS) -> list[str]:
    """Model inputs: names that begin with an origin mark, then calendar columns."""
    return starting_with(columns, *marks) + list(extra)


def starting_with(columns: Iterable[str], *starts: str) -> list[str]:
    return [c for c in columns if c.startswith(starts)]


def compare_names(left: Iterable[str], right: Iterable[str]) -> dict[str, list[str]]:
    """Sorted schema difference of two sources."""
    a, b = set(left), set(right)
    return {"both": sorted(a & b), "left_only": sorted(a - b), "right_only": sorted(b - a)}


def label_from(text: Column, pieces: Mapping[str, str]) -> Column:
    """First label whose piece occurs in ``text``; NULL when none does."""
    found = None
    for piece, label in pieces.items():
        test = text.contains(piece)
        found = F.when(test, label) if found is None else found.when(test, label)
    return found


def variable_of(file_name: Column) -> Column:
    """Variable code in an archive file name, NULL when there is none."""
    code = F.regexp_extract(file_name, VARIABLE_IN_FILE_NAME, 0)
    return F.when(code != "", code)
