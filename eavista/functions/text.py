"""Text expressions. All are plain Column expressions and stay inside codegen."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F

from eavista import values


def quoted(text: str) -> str:
    """The text as an SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def fixed_map(table: Mapping[str, object]) -> Column:
    """A fixed lookup table as a map literal."""
    shown = lambda v: quoted(v) if isinstance(v, str) else str(v)
    return F.expr("map(" + ", ".join(f"{quoted(k)}, {shown(v)}" for k, v in table.items()) + ")")


def number_sql(x: str) -> str:
    """SQL for a number as a report shows it: ``120``, not ``120.0``."""
    return (
        f"CASE WHEN {x} = floor({x}) AND abs({x}) < 1e18 THEN string(bigint({x})) "
        f"ELSE string({x}) END"
    )


def number_text(column: str) -> Column:
    return F.expr(number_sql(column))


def labelled_sentence(parts: Iterable[tuple[str, str]], end: str = ". ") -> Column:
    """``Label: value. `` for each value that is present; empty text when none is.

    The parts are (label, SQL expression of the text).
    """
    texts = ", ".join(f"concat({quoted(label)}, {sql}, {quoted(end)})" for label, sql in parts)
    return F.expr(f"concat_ws('', {texts})")


def join_present(separator: str, *parts: Column) -> Column:
    """The present parts joined by ``separator``; null when no part is present."""
    return F.nullif(F.concat_ws(separator, *parts), F.lit(""))


def prefixed(prefix: str, col: Column) -> Column:
    """``prefix`` before the text, null when there is no text."""
    return F.concat(F.lit(prefix), col)


def fold_key(col: Column) -> Column:
    """Comparison key that ignores case, accents and trailing spaces."""
    return F.translate(F.lower(F.rtrim(col)), "áéíóúüàèìòùâêîôûäëïöñç", "aeiouuaeiouaeiouaeionc")


def recode(col: Column, names: Mapping[str, str], default: Column | None = None) -> Column:
    """Replace ``col`` by its entry in a fixed table, matched on the folded key."""
    folded = F.transform_keys(fixed_map(names), lambda k, _: fold_key(k))
    found = F.try_element_at(folded, fold_key(col))
    return found if default is None else F.coalesce(found, default)


def paternal_surname(surname: Column) -> Column:
    return F.trim(F.substring_index(surname, " ", 1))


def maternal_surname(surname: Column) -> Column:
    """What follows the first surname, counted in characters; null for a single surname."""
    first = paternal_surname(surname)
    rest = F.trim(F.substring(surname, F.length(first) + 1, F.length(surname)))
    return F.when(surname != first, rest)


def latin1_text(col: Column) -> Column:
    """Characters outside Latin-1 become ``?``."""
    return F.regexp_replace(col, r"[^\x{00}-\x{FF}]", "?")


def without_blacklisted(col: Column) -> Column:
    """Drop characters that are neither basic Latin nor letters."""
    return F.regexp_replace(col, values.CSV_BLACKLIST, "")


def sheet_name(date: Column, number: Column, surname: Column | None = None) -> Column:
    """``Surname-2021-01-31 17``; a single-patient document leaves the surname out."""
    tail = F.concat(F.date_format(date, "yyyy-MM-dd"), F.lit(" "), number.cast("string"))
    return tail if surname is None else F.concat(surname, F.lit("-"), tail)


def wrap_words(col: Column, width: int) -> Column:
    """Greedy word wrap into lines of at most ``width`` characters; words are kept whole.

    A first word that is longer than ``width`` leaves an empty first line.
    """
    text = "cast('' as string)"
    start = F.struct(
        F.array().cast("array<string>").alias("lines"), F.expr(text).alias("line")
    )

    def add(state: Column, word: Column) -> Column:
        longer = F.when(state["line"] == "", word).otherwise(
            F.concat(state["line"], F.lit(" "), word)
        )
        fits = F.length(longer) <= width
        return F.struct(
            F.when(fits, state["lines"])
            .otherwise(F.array_append(state["lines"], state["line"]))
            .alias("lines"),
            F.when(fits, longer).otherwise(word).alias("line"),
        )

    def finish(state: Column) -> Column:
        return F.when(state["line"] == "", state["lines"]).otherwise(
            F.array_append(state["lines"], state["line"])
        )

    return F.aggregate(F.split(col, " ", -1), start, add, finish)


def address_lines(address: Mapping[str, Column]) -> list[Column]:
    """The two address lines: town and street, then district and state."""
    return [
        F.concat_ws(", ", address["city_village"], address["address1"]),
        F.concat_ws(", ", address["county_district"], address["state_province"]),
    ]
