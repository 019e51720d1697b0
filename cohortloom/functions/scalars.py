"""Scalar derivations as Column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortloom import fixed_values as fv
from cohortloom.functions.missing import _col, fill_default


def decode(c: Column | str, table: dict[str, str], default: str | None = None) -> Column:
    """Code to label; codes outside ``table`` give ``default`` (NULL if none)."""
    pairs = F.create_map(*[F.lit(v) for v in chain.from_iterable(table.items())])
    label = F.try_element_at(pairs, _col(c))
    return label if default is None else F.coalesce(label, F.lit(default))


def char_from_end(c: Column | str, position: int = 2) -> Column:
    """The character ``position`` places from the end, trailing spaces ignored."""
    text = F.rtrim(_col(c))
    return F.when(F.length(text) >= position, F.substring(text, -position, 1))


def code_normalise(c: Column | str) -> Column:
    """Drop the third character of a code: 14.0901 becomes 140901."""
    c = _col(c)
    return F.concat_ws("", F.trim(F.substring(c, 1, 2)), F.trim(c.substr(4, 1 << 30)))


def starts_with(c: Column | str, prefix: str) -> Column:
    """Prefix test that is False, never NULL, for missing text."""
    return F.coalesce(F.startswith(_col(c), F.lit(prefix)), F.lit(False))


def prefix_flag(c: Column | str, prefix: str) -> Column:
    return F.when(starts_with(c, prefix), "Y").otherwise("N")


def label_concat(word: str, c: Column | str, missing: str = "Missing") -> Column:
    """``word`` and the value, or the missing label."""
    c = _col(c)
    return F.when(c.isNull(), missing).otherwise(F.concat_ws(" ", F.lit(word), c.cast("string")))


def binary_recode(c: Column | str) -> Column:
    """0 stays 0, anything else becomes 1, missing stays missing."""
    c = _col(c)
    return F.when(c == 0, 0).when(c.isNotNull(), 1)


def year_from_term(term: Column | str) -> Column:
    """Four-digit year of a term code such as 2186."""
    return F.concat(F.lit("20"), F.substring(_col(term), 2, 2))


def same_day_last_year(d: Column | str) -> Column:
    """The day one year earlier; 29 February becomes 28 February."""
    return F.add_months(_col(d), -12)


def day_distance(start: Column | str, end: Column | str) -> Column:
    return F.datediff(_col(end), _col(start))


def picture_percent(c: Column | str) -> Column:
    """Two decimals, at least one integer digit, and a percent sign."""
    return F.format_string("%.2f%%", _col(c))


def zero_pad(c: Column | str, width: int) -> Column:
    """Integer with leading zeros; wider numbers are kept whole."""
    return F.format_string(f"%0{width}d", _col(c).cast("bigint"))


def json_path_default(c: Column | str, path: str, default: str) -> Column:
    """Value at a path; ``default`` when the path is absent, NULL when it holds JSON null."""
    found = F.try_variant_get(F.try_parse_json(_col(c)), path, "variant")
    return F.when(found.isNull(), F.lit(default)).when(
        ~F.is_variant_null(found), F.try_variant_get(F.try_parse_json(_col(c)), path, "string")
    )


def size_step_up(c: Column | str, ladder: list[int] | None = None) -> Column:
    """The ladder step equal to the value, else the next larger one, else the largest."""
    steps = sorted(ladder or fv.IMAGE_WIDTHS)
    c = _col(c)
    ladder_col = F.array(*[F.lit(s) for s in steps])
    return F.coalesce(F.try_element_at(F.filter(ladder_col, lambda s: s >= c), F.lit(1)), F.lit(steps[-1]))


def _band(hours: Column, bands) -> Column:
    standing = F.lit(None).cast("string")
    for letter, low, high in bands:
        inside = hours >= low if high is None else hours.between(low, high)
        standing = F.when(inside, letter).otherwise(standing)
    return standing


def band_ladder(hours: Column | str, career: Column | str, load: Column | str) -> Column:
    """Standing from hours and career; NULL in the gaps between bands.

    A band wins over the withdrawn rule because withdrawn needs zero hours.
    """
    hours = fill_default(hours, 0.0)
    career = _col(career)
    by_hours = F.when(career.isin(fv.GRADUATE_CAREERS), _band(hours, fv.GRADUATE_BANDS)).when(
        career.isin(fv.UNDERGRADUATE_CAREERS), _band(hours, fv.UNDERGRADUATE_BANDS)
    )
    withdrawn = F.when(_col(load).eqNullSafe(fv.WITHDRAWN) & (hours == 0), fv.WITHDRAWN)
    return F.coalesce(by_hours, withdrawn)


def resolve_standing(standing: Column | str) -> Column:
    """Every row left without a standing, audited or not, counts as less than half time."""
    return F.coalesce(_col(standing), F.lit(fv.LESS_THAN_HALF))


def needs_review(standing: Column | str, audit_units: Column | str) -> Column:
    """True for rows without a standing that no audit units explain."""
    return _col(standing).isNull() & ~F.coalesce(_col(audit_units) > 0, F.lit(False))


def media_label(media_type: Column, ts: Column, caption: Column, limit: int = fv.MEDIA_LABEL_LIMIT) -> Column:
    """Description of a post, cut to ``limit`` characters, dots after a cut word."""
    kind = F.regexp_replace(F.lower(media_type), "^([^_]*)_", "$1 ")
    whole = F.concat(kind, F.lit(" shared on "), F.date_format(ts, "EEE MMM dd yyyy"), F.lit(" | "), caption)
    cut = F.substring(whole, 1, limit)
    return F.when((F.length(cut) == limit) & cut.rlike("[A-Za-z0-9]$"), F.concat(cut, F.lit("..."))).otherwise(cut)


def media_source(media_type: Column, media_url: Column, thumbnail_url: Column) -> Column:
    """Address of the picture shown for a post: videos show their thumbnail."""
    return F.when(media_type.eqNullSafe(fv.MEDIA_VIDEO), thumbnail_url).otherwise(media_url)


def media_alt(caption: Column, label: Column, title: Column) -> Column:
    """The label of a post with a caption, else its title."""
    return F.when(F.coalesce(caption, F.lit("")) != "", label).otherwise(title)


def media_title(title: Column, caption: Column) -> Column:
    """The title, or the caption of a post without one."""
    return F.when(F.coalesce(title, F.lit("")) != "", title).otherwise(caption)
