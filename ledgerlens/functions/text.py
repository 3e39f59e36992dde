"""E-mail, device, browser, screen and identity expressions. Arguments and results are SQL text."""

from __future__ import annotations

from .sqltext import lit, lits, map_of

_BLANKS = "' \\t\\n\\r\\f'"


def strip(col: str) -> str:
    return f"btrim({col}, {_BLANKS})"


def clean_null_token(col: str, tokens) -> str:
    """Null for text that only spells a missing value."""
    return f"CASE WHEN lower({strip(col)}) IN ({lits(tokens)}) THEN NULL ELSE {col} END"


def first_word(col: str) -> str:
    """First token of whitespace-separated text, null when there is none."""
    return f"nullif(split({strip(col)}, '\\\\s+', 2)[0], '')"


# ---- e-mail -------------------------------------------------------------------------------

def normalise_email(col: str) -> str:
    return f"lower(coalesce({col}, 'missing'))"


def host_labels(domain: str) -> str:
    """Labels of a host name as an array."""
    return f"split({strip(f'lower({domain})')}, '[.]')"


def host_tail(labels: str) -> str:
    """Last two labels, joined."""
    return f"array_join(slice({labels}, -2, 2), '.')"


# The functions below take the normalised host and, to work them out only once, columns already
# holding `host_labels` and `host_tail` of it.

def email_suffix(domain: str, labels: str, tail: str, two_part) -> str:
    """Public suffix of a host; known two-part suffixes stay whole, '' when there is none."""
    return (
        f"CASE WHEN {domain} IN ('', 'missing', 'nan') OR size({labels}) = 1 THEN '' "
        f"WHEN {tail} IN ({lits(two_part)}) THEN {tail} ELSE element_at({labels}, -1) END"
    )


def email_name(domain: str, labels: str, tail: str, two_part) -> str:
    """The label left of the public suffix."""
    return (
        f"CASE WHEN {domain} IN ('', 'missing', 'nan') THEN 'missing' WHEN size({labels}) = 1 THEN {labels}[0] "
        f"WHEN {tail} IN ({lits(two_part)}) AND size({labels}) >= 3 THEN element_at({labels}, -3) "
        f"ELSE element_at({labels}, -2) END"
    )


def email_subdomain(domain: str, labels: str, tail: str, two_part) -> str:
    """Labels left of the name, '' when there are none."""
    drop = f"CASE WHEN {tail} IN ({lits(two_part)}) THEN 3 ELSE 2 END"
    return (
        f"CASE WHEN {domain} IN ('', 'missing', 'nan') OR size({labels}) <= {drop} THEN '' "
        f"ELSE array_join(slice({labels}, 1, greatest(size({labels}) - {drop}, 0)), '.') END"
    )


def email_vendor(name: str, vendors: dict) -> str:
    return f"coalesce(try_element_at({map_of(vendors)}, {name}), 'other')"


def email_tld(suffix: str) -> str:
    return f"coalesce(nullif({suffix}, ''), 'missing')"


def email_presence(payer: str, receiver: str) -> str:
    return (
        f"CASE WHEN {payer} <> 'missing' AND {receiver} <> 'missing' THEN 'both_present' "
        f"WHEN {payer} <> 'missing' THEN 'only_P' WHEN {receiver} <> 'missing' THEN 'only_R' "
        f"ELSE 'both_missing' END"
    )


# ---- device -------------------------------------------------------------------------------

def device_brand(info: str) -> str:
    return f"coalesce({first_word(f'''split({info}, '/', 2)[0]''')}, 'unknown')"


def text_length(col: str) -> str:
    return f"coalesce(length({col}), 0)"


def browser_name(col: str) -> str:
    return f"coalesce(lower({first_word(col)}), 'unknown')"


def mentions(col: str, word: str) -> str:
    return f"coalesce(CAST(contains(lower({col}), {lit(word)}) AS INT), 0)"


def before_space(col: str) -> str:
    return f"coalesce(nullif(split({col}, ' ', 2)[0], ''), 'unknown')"


def after_space(col: str) -> str:
    return f"coalesce(nullif(try_element_at(split({col}, ' ', 2), 2), ''), 'unknown')"


def screen_side(col: str, position: int) -> str:
    """Side `position` (1 width, 2 height) of `WxH`; -1 when it cannot be read."""
    side = f"try_cast(try_element_at(split({col}, 'x'), {position}) AS INT)"
    return f"coalesce(CASE WHEN contains({col}, 'x') THEN {side} END, -1)"


def screen_aspect(width: str, height: str) -> str:
    return f"CASE WHEN {height} > 0 THEN {width} / {height} ELSE -1D END"


# ---- identity -----------------------------------------------------------------------------

def status_number(col: str) -> str:
    """Integer after the first colon (`match_status:2`), -1 when there is none."""
    return f"coalesce(try_cast(try_element_at(split({col}, ':'), 2) AS INT), -1)"
