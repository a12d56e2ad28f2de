"""Checks of text against strftime patterns and common date layouts."""

from __future__ import annotations

import re

from .sqltext import quote

# The documented strptime directives and the text each accepts.
DIRECTIVES = {
    "Y": r"[0-9]{4}",
    "y": r"[0-9]{2}",
    "m": r"1[0-2]|0[1-9]|[1-9]",
    "d": r"3[01]|[12][0-9]|0[1-9]|[1-9]",
    "H": r"2[0-3]|[01][0-9]|[0-9]",
    "I": r"1[0-2]|0[1-9]|[1-9]",
    "M": r"[0-5][0-9]|[0-9]",
    "S": r"6[01]|[0-5][0-9]|[0-9]",
    "f": r"[0-9]{1,6}",
    "p": r"(?i:am|pm)",
    "b": r"(?i:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)",
    "B": r"(?i:january|february|march|april|may|june|july|august|september|october|november|december)",
    "A": r"(?i:monday|tuesday|wednesday|thursday|friday|saturday|sunday)",
    "a": r"(?i:mon|tue|wed|thu|fri|sat|sun)",
    "j": r"36[0-6]|3[0-5][0-9]|[12][0-9]{2}|0[1-9][0-9]|00[1-9]|[1-9][0-9]|[1-9]",
    "z": r"[+-][0-9]{2}:?[0-5][0-9]|Z",
    "%": r"%",
}

END = r"\z"
# What a month's name may go on with after its first three letters. Fixed values.
REST = dict(enumerate(("uary", "ruary", "ch", "il", "", "e", "y", "ust", "ember", "ober", "ember", "ember"), 1))
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

def matches_strftime(text: str, pattern: str) -> str:
    """SQL that is true where ``text`` parses with the strftime pattern.

    The pattern becomes one anchored regex; if it has a day, the day is also
    checked against its month.  Without a year it is that of 1900, as in strptime.
    """
    pattern = pattern.replace("%T", "%H:%M:%S").replace("%R", "%H:%M").replace("%D", "%m/%d/%y").replace("%F", "%Y-%m-%d")
    regex, groups = _regex(pattern)
    matched = f"{text} RLIKE {quote(regex)}"
    if "d" not in groups:
        return matched
    if pattern == "%Y-%m-%d":
        return f"CASE WHEN {matched} THEN TRY_CAST({text} AS DATE) IS NOT NULL ELSE false END"

    # Rewrite the text as year-month-day in one step; other text becomes "--".
    year = f"${groups['Y']}" if "Y" in groups else f"20${groups['y']}" if "y" in groups else "1900"
    named = groups.get("b") or groups.get("B")
    month = f"${named}" if named else f"${groups['m']}" if "m" in groups else "1"
    day = f"regexp_replace({text}, {quote(regex + '|^(?s:.*)' + END)}, '{year}-{month}-${groups['d']}')"
    if named:
        for number, name in enumerate(MONTHS, 1):
            day = f"regexp_replace({day}, '(?i)-{name}[a-z]*-', '-{number}-')"
    return f"TRY_CAST({day} AS DATE) IS NOT NULL"


def is_parseable(text: str) -> str:
    """SQL that is true where the text reads as a date or a time, in ISO 8601 or another common written form."""
    return f"TRY_CAST({text} AS TIMESTAMP) IS NOT NULL OR {text} RLIKE {quote(written_date())}"


def written_date() -> str:
    """One regex for dates and times as people write them.

    A date is a month with a day it has, in one of the usual orders, with or
    without year; an optional weekday goes before it and an optional time with
    a zone after it.  A weekday, a month or a time may stand alone.
    """

    def one_of(*options: str) -> str:
        return f"(?:{'|'.join(options)})"

    def named(*numbers: int) -> str:
        return one_of(*(f"{MONTHS[n - 1]}{'t?' if n == 9 else ''}(?:{REST[n]})?" for n in numbers))

    leap = one_of("[0-9]{2}(?:0[48]|[2468][048]|[13579][26])", "(?:[02468][048]|[13579][26])00")
    short_leap = one_of("[02468][048]", "[13579][26]")
    first = "[12][0-9]|0?[1-9]"
    # (months by number, by two digits, by name), days, days in two digits, years, short years
    parts = [
        (one_of("0?[13578]", "1[02]"), one_of("0[13578]", "1[02]"), named(1, 3, 5, 7, 8, 10, 12), "3[01]|"),
        (one_of("0?[469]", "11"), one_of("0[469]", "11"), named(4, 6, 9, 11), "30|"),
        ("0?2", "02", named(2), ""),
    ]
    gap, mark = r"(?:[\s,./-]+|\.\s*)", "[/.-]"
    year4, year2 = "[0-9]{4}", "'?[0-9]{2}"
    dates = []

    def add(number: str, two: str, name: str, day: str, two_day: str, year: str, short: str, without: bool) -> None:
        nth = f"{day}(?:st|nd|rd|th)?"
        any_year = one_of(year, short)
        dates.extend(
            [
                f"{number}{mark}{day}{mark}{any_year}",
                f"{day}{mark}{number}{mark}{any_year}",
                f"{year}{mark}{number}{mark}{day}",
                f"{year}{two}{two_day}",
                f"{nth}(?:{gap}|\\s*(?:of\\s+)?){name}{gap}?{any_year}",
                f"{name}{gap}{nth}{gap}{any_year}",
                f"{year}{gap}{name}{gap}{day}",
                f"{name}\\s+{day}\\s+TIME\\s+{year}",
            ]
        )
        if without:
            dates.extend([f"{nth}(?:{gap}|\\s*(?:of\\s+)?){name}", f"{name}{gap}{nth}", f"{number}/{day}", f"{day}/{number}"])

    for number, two, name, last in parts:
        two_day = one_of(*(f"{last}[12][0-9]|0[1-9]".split("|"))) if last else one_of("2[0-8]", "1[0-9]", "0[1-9]")
        day = f"(?:{last}{first})" if last else "(?:2[0-8]|1[0-9]|0?[1-9])"
        add(number, two, name, day, two_day, year4, year2, True)
        dates.extend([f"{name}{gap}{year4}", f"{year4}{gap}{name}", f"{year4}{mark}{number}", name])
        if not last:
            add(number, two, name, "29", "29", leap, short_leap, True)
    time = one_of(
        r"(?:1[0-2]|0?[1-9])(?::[0-5]?[0-9](?::[0-5]?[0-9](?:[.,][0-9]+)?)?)?\s*[ap]\.?m\.?",
        r"(?:2[0-3]|[01]?[0-9]):[0-5]?[0-9](?::[0-5]?[0-9](?:[.,][0-9]+)?)?",
        r"(?:2[0-3]|[01]?[0-9])\s*h(?:ours?)?(?:\s*[0-5]?[0-9]\s*m(?:in(?:utes?)?)?)?",
    )
    compact = "(?:2[0-3]|[01][0-9])[0-5][0-9](?:[0-5][0-9])?"
    zone = r"(?:\s*(?:z|utc|gmt)|\s*[+-][0-9]{2}(?::?[0-9]{2})?)?"
    weekday = "(?:mon|tue|tues|wed|weds|thu|thur|thurs|fri|sat|sun|(?:mon|tues|wednes|thurs|fri|satur|sun)day)"
    whole = one_of(*dates).replace("TIME", time)
    after = f"(?:(?:(?:t|[\\s,]+(?:at\\s+)?){time}|t{compact}|(?<=[0-9]{{8}}){compact}){zone})?"
    return rf"(?i)^\s*(?:(?:{weekday}[\s,.]+)?{whole}{after}|{time}{zone}|{weekday})\s*" + END


def _regex(pattern: str) -> tuple[str, dict[str, int]]:
    pieces, groups, i = ["^"], {}, 0
    while i < len(pattern):
        if pattern[i] != "%":
            pieces.append(re.escape(pattern[i]))
            i += 1
            continue
        letter = pattern[i + 1 : i + 2]
        if letter not in DIRECTIVES:
            raise ValueError(f"directive %{letter} of {pattern!r} is not supported")
        if letter != "%" and letter in groups:
            raise ValueError(f"directive %{letter} occurs twice in {pattern!r}")
        if letter != "%":
            groups[letter] = len(groups) + 1
            pieces.append(f"({DIRECTIVES[letter]})")
        else:
            pieces.append("%")
        i += 2
    return "".join(pieces) + END, groups
