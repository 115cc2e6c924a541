"""Text expressions."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

# Every character Unicode counts as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def trimmed(*names: str) -> dict[str, Column]:
    """``withColumns`` map that strips ASCII spaces (tabs stay)."""
    return {name: F.trim(F.col(name)) for name in names}


def recode(
    col: Column, mapping: Mapping[str, object], otherwise: Column, fold: bool = True
) -> Column:
    """Replace labels by ``mapping``; ``otherwise`` answers for the rest.

    ``fold`` matches on the trimmed, lower-case label. A mapping of any size works; one that
    is data rather than code belongs in a table: see ``operators.lookup.attach``.
    """
    if not mapping:
        return otherwise
    label = F.lower(F.trim(col)) if fold else col
    table = F.create_map(*[F.lit(v) for pair in mapping.items() for v in pair])
    return F.coalesce(F.try_element_at(table, label), otherwise)


def free_text_key(col: Column) -> Column:
    """Compare form of free text: underscores to spaces, then strip, then lower case."""
    return F.lower(strip_all_space(F.replace(col, F.lit("_"), F.lit(" "))))


def strip_all_space(col: Column) -> Column:
    """Strip every Unicode space character, not only the ASCII one."""
    return F.btrim(col, F.lit(WHITE_SPACE))


def route_key(start: Column, end: Column, separator: str = "-", upper: bool = False) -> Column:
    """``A-B``. A missing end is left out, as ``concat_ws`` does."""
    ends = [F.upper(start), F.upper(end)] if upper else [start, end]
    return F.concat_ws(separator, *ends)


def random_id() -> Column:
    """A new random id per row, for events whose replays need not be told apart."""
    return F.uuid()


def business_id(columns: Sequence[str]) -> Column:
    """An event id that a replay of the same record gets again."""
    return F.sha2(
        F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns]),
        256,
    )
