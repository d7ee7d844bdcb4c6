"""Scalar functions as Column expressions; all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def span(seq: Column, start: Column, stop: Column) -> Column:
    """1-based closed slice."""
    return F.substr(seq, start, stop - start + 1)


def find(seq: Column, part: Column) -> Column:
    """0-based place of ``part``, -1 if it is absent."""
    return F.position(part, seq) - 1


def strip_gaps(aligned: Column) -> Column:
    return F.upper(F.regexp_replace(aligned, r"[.\-~]", ""))


def protein_id(name: Column) -> Column:
    """Protein of a member name: before `/`, then before `_`."""
    return F.split_part(F.split_part(name, F.lit("/"), F.lit(1)), F.lit("_"), F.lit(1))


def base_name(name: Column) -> Column:
    return F.split_part(name, F.lit("/"), F.lit(1))


def family_start(name: Column) -> Column:
    """First residue of a family member in its protein, by the number of underscores:
    none 1; `id/a_b` a; `id_a_b` a; `id_a_b/c_d` a + c - 1."""
    n = F.length(name) - F.length(F.replace(name, F.lit("_"), F.lit("")))
    second = F.try_element_at(F.split(name, "_"), F.lit(2)).try_cast("int")
    region = F.split_part(F.split_part(name, F.lit("/"), F.lit(2)), F.lit("_"), F.lit(1)).try_cast("int")
    return F.when(n == 0, 1).when(n == 1, region).when(n == 2, second).when(n == 3, second + region - 1)


def formatted_id(number: Column, prefix: str, digits: int = 10) -> Column:
    text = number.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(text) >= digits, text).otherwise(F.lpad(text, digits, "0")))


def fit_width(name: Column, width: Column) -> Column:
    """Pad with spaces to a width, or cut to it."""
    return F.call_function("rpad", name, width, F.lit(" "))


def renamed_member(raw: Column, length: Column, whole_width: Column, original_length: Column, start: Column, cut: bool = True) -> Column:
    """New name of an aligned row: ``raw`` is its name before `/`, found at the
    0-based ``start`` of a source of ``original_length`` residues."""
    parts = F.split(raw, "_")
    sliced = F.size(parts) == 3
    a = F.try_element_at(parts, F.lit(2))
    full = F.when(sliced, F.concat(parts[0], F.lit("/"), a, F.lit("-"), F.try_element_at(parts, F.lit(3)))).otherwise(raw)
    new_start = start + a.try_cast("int")
    part = F.when(sliced, F.concat(parts[0], F.lit("/"), new_start, F.lit("-"), new_start + length - 1)).otherwise(
        F.concat(parts[0], F.lit("/"), start + 1, F.lit("-"), start + length)
    )
    return F.when(length == original_length, full).otherwise(fit_width(part, whole_width) if cut else part)


def percent(part: Column, whole: Column) -> Column:
    """Half-even percentage of two digits; null for an empty whole."""
    return F.when(whole != 0, F.bround(part / whole * 100, 2))


def label_percent(labels: Column, label: str) -> Column:
    return percent(F.length(labels) - F.length(F.replace(labels, F.lit(label), F.lit(""))), F.length(labels))


def path_label(path: Column) -> Column:
    return F.element_at(F.split(path, ":"), -1)


def path_parent(path: Column) -> Column:
    return F.when(F.contains(path, F.lit(":")), F.regexp_replace(path, r":[^:]*$", "")).otherwise("")


def path_prefixes(path: Column) -> Column:
    parts = F.split(path, ":")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), ":"))


def string_color(text: Column) -> Column:
    """`#rrggbb` of a string: h = 31 h + character, low byte first."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    h = F.aggregate(chars, F.lit(0).cast("long"), lambda acc, c: F.pmod(acc * 31 + F.ascii(c), F.lit(1 << 24)))
    byte = lambda i: F.lower(F.lpad(F.hex(F.shiftright(h, 8 * i).bitwiseAND(F.lit(255).cast("long"))), 2, "0"))
    return F.concat(F.lit("#"), byte(0), byte(1), byte(2))


def luminance(color: Column) -> Column:
    def channel(i: int) -> Column:
        c = F.conv(F.substring(color, i, 2), 16, 10).cast("double") / 255.0
        return F.when(c <= 0.03928, c / 12.92).otherwise(F.pow((c + 0.055) / 1.055, F.lit(2.4)))

    return channel(2) * 0.2126 + channel(4) * 0.7152 + channel(6) * 0.0722


def font_color(color: Column) -> Column:
    return F.when(luminance(color) > 0.2, "black").otherwise("white")


def csv_quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))


def single_spaced(text: Column) -> Column:
    return F.regexp_replace(F.trim(text), r"\s+", " ")


def accession(text: Column) -> Column:
    """An accession without its version."""
    return F.split_part(text, F.lit("."), F.lit(1))


def file_stem(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(path, r"([^/]+)$", 1), r"\.[^.]*$", "")
