"""License notices in documents, in DataFrame operations only.

A notice matches where a document's window holds four fifths of the notice's
shingles of five words.  Windows overlap: for notices of up to c shingles they
begin every ``stride`` shingles and are long enough to hold any c in a row.
Each shingle has one hash per band; a window's least hash in each band is its
MinHash, and a window that agrees with a notice in any band is a candidate.
A window with four fifths of a notice has at least a known similarity with it,
and each size has as many bands as make the chance to miss it less than MISS.
Candidates are verified by exact containment, and by phrases that tell versions
and families apart: of the notice's shingles that hold such a phrase, the
window must hold one.  A notice of fewer than five words is one shingle.

All of it is one projection: no shuffle, and a document's length is its only
cost.  Documents without any of a few words, one of which a match has to hold,
are not cut into words at all.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHINGLE, SHARE, MISS = 5, 0.8, 1e-4
SEED = 42
#: Sizes of notices, in shingles; each has windows of its own.
SIZES = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128)

# Common notices: id, family, wording, and phrases that no other version or family has.  Fixed values.
NOTICES = [
    ("Apache-2.0", "permissive", "Licensed under the Apache License, Version 2.0"),
    (
        "Apache-2.0",
        "permissive",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("MIT", "permissive", "Released under the MIT License"),
    ("MIT", "permissive", "Licensed under the MIT License"),
    (
        "MIT",
        "permissive",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        ' documentation files (the "Software"), to deal in the Software without restriction',
    ),
    (
        "ISC",
        "permissive",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
        " hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    ),
    (
        "BSD-3-Clause",
        "permissive",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met",
    ),
    ("Unlicense", "permissive", "This is free and unencumbered software released into the public domain"),
    ("CC0-1.0", "permissive", "This work is dedicated to the public domain under CC0 1.0 Universal"),
    ("CC-BY-4.0", "permissive", "Licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-4.0", "permissive", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "copyleft", "Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-SA-4.0", "copyleft", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "restricted", "Licensed under CC BY-NC 4.0"),
    (
        "CC-BY-NC-4.0",
        "restricted",
        "Licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    ("CC-BY-ND-4.0", "restricted", "Licensed under CC BY-ND 4.0"),
    ("CC-BY-ND-4.0", "restricted", "Licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
    ("CC-BY-NC-SA-4.0", "restricted", "Licensed under CC BY-NC-SA 4.0"),
    (
        "CC-BY-NC-SA-4.0",
        "restricted",
        "Licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License",
        "noncommercial sharealike",
    ),
    ("CC-BY-NC-ND-4.0", "restricted", "Licensed under CC BY-NC-ND 4.0"),
    (
        "CC-BY-NC-ND-4.0",
        "restricted",
        "Licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License",
        "noncommercial noderivatives",
    ),
    ("GPL-3.0", "copyleft", "This work is licensed under the GNU General Public License, version 3", "version 3"),
    ("GPL-2.0", "copyleft", "This work is licensed under the GNU General Public License, version 2", "version 2"),
    (
        "GPL-3.0",
        "copyleft",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License",
        "gnu general",
        "version 3",
    ),
    (
        "GPL-2.0",
        "copyleft",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation; either version 2 of the License",
        "gnu general",
        "version 2",
    ),
    (
        "LGPL-3.0",
        "copyleft",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser"
        " General Public License as published by the Free Software Foundation, either version 3 of the License",
        "lesser general",
        "version 3",
    ),
    (
        "LGPL-2.1",
        "copyleft",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser"
        " General Public License as published by the Free Software Foundation; either version 2.1 of the License",
        "lesser general",
        "version 2 1",
    ),
    (
        "AGPL-3.0",
        "copyleft",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero"
        " General Public License as published by the Free Software Foundation, either version 3 of the License",
        "affero general",
        "version 3",
    ),
    (
        "EPL-2.0",
        "copyleft",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License"
        " 2.0 which is available at https://www.eclipse.org/legal/epl-2.0",
        "public license 2 0",
    ),
    ("reserved", "restricted", "All rights reserved."),
    ("reserved", "restricted", "No part of this publication may be reproduced without prior written permission"),
    ("proprietary", "restricted", "This document is proprietary and confidential"),
    (
        "proprietary",
        "restricted",
        "Unauthorized copying of this file, via any medium is strictly prohibited. Proprietary and confidential",
    ),
    (
        "MPL-2.0",
        "copyleft",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was"
        " not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/",
    ),
]
RESERVED = "reserved"
# Words too common to tell whether a document may hold a notice. Fixed values.
COMMON = frozenset("the of and to in is for with this that be or a as by it not you are any at an on from if all".split())


def words(text: str) -> list[str]:
    return [w for w in re.split("[^a-z0-9]+", text.lower()) if w]


def shingles(text: str) -> list[str]:
    found = words(text)
    width = min(SHINGLE, len(found))
    return list(dict.fromkeys(" ".join(found[i : i + width]) for i in range(len(found) - width + 1) if width))


class Notice:
    """A notice with the windows for its size."""

    def __init__(self, license_id: str, family: str, text: str, *telling: str) -> None:
        self.license_id, self.family, self.shingles = license_id, family, shingles(text)
        if not self.shingles:
            raise ValueError("a notice needs a word")
        #: Words in its shingles: fewer than usual if it has fewer itself.
        self.width = min(SHINGLE, len(words(text)))
        self.need = math.ceil(SHARE * len(self.shingles) - 1e-9)
        self.size = next(c for c in SIZES if c >= len(self.shingles))
        self.stride = max(1, self.size // 2)
        self.window = self.size + self.stride - 1
        #: For each telling phrase the shingles that hold it, of which one is asked for.
        self.telling = [[s for s in self.shingles if f" {phrase} " in f" {s} "] for phrase in telling]
        if not all(self.telling):
            raise ValueError(f"a phrase of {telling} is in no shingle of {text!r}")

    @property
    def bands(self) -> int:
        similarity = self.need / (self.window + len(self.shingles) - self.need)
        return 1 if similarity == 1 else math.ceil(math.log(MISS) / math.log(1 - similarity))


def anchors(notices: list[Notice]) -> list[str]:
    """A few words, as rare as may be, of which a text has to hold one to match a notice.

    A notice of m shingles, of which ``need`` are asked for, can't match
    without one of any m - need + 1 of them, so it is enough that so many hold
    one of the words.
    """
    found: list[str] = []

    def open_shingles(notice: Notice) -> list[str]:
        left = [s for s in notice.shingles if not any(w in s for w in found)]
        return left if len(left) >= notice.need else []

    while left := [s for n in notices for s in open_shingles(n)]:
        covered: dict[str, int] = {}
        for shingle in left:
            for word in set(shingle.split()) - COMMON or set(shingle.split()):
                covered[word] = covered.get(word, 0) + 1
        found.append(max(sorted(covered), key=lambda w: covered[w] * len(w) ** 2))
    return found


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def shingle_hash(shingle: str) -> int:
    from xxhash import xxh64_intdigest

    return _signed(xxh64_intdigest(shingle.encode(), SEED))


def band_hash(value: int, band: int) -> int:
    """What xxhash64(value, band) is for a long and an int."""
    from xxhash import xxh64_intdigest

    first = xxh64_intdigest(value.to_bytes(8, "little", signed=True), SEED)
    return _signed(xxh64_intdigest(band.to_bytes(4, "little", signed=True), first))


def _longs(values: list[int]) -> str:
    # The least long has no literal of its own.
    return ", ".join(f"{v}L" if v > -(2**63) else "(-9223372036854775807L - 1L)" for v in values)


def scan(docs: DataFrame, given: list[tuple[str, ...]] = NOTICES) -> DataFrame:
    """(doc_id, n_licenses, licenses, restricted) of every document; a null or empty text has none.

    ``licenses`` are the ids found, sorted and comma-joined; ``restricted``
    says whether one of them is not permissive; that rights are reserved
    counts only where no license is given.
    """
    notices = [Notice(*n) for n in given]
    widths = sorted({n.width for n in notices})
    none = "cast(array() as array<{}>)"

    def may(own: list[Notice]) -> str:
        return "(" + " or ".join(f"contains(low, '{w}')" for w in anchors(own)) + ")"

    found = docs.selectExpr("doc_id", "lower(coalesce(text, '')) as low")
    found = found.selectExpr(
        "doc_id",
        "low",
        f"case when {may(notices)} then filter(split(low, '[^a-z0-9]+'), w -> w != '') else {none.format('string')} end as w",
    )
    found = found.selectExpr(
        "doc_id",
        *[
            f"case when size(w) >= {k} and {may([n for n in notices if n.width == k])}"
            f" then transform(sequence(1, size(w) - {k - 1}), i -> xxhash64(array_join(slice(w, i, {k}), ' ')))"
            f" else {none.format('bigint')} end as sh{k}"
            for k in widths
        ],
    )
    bands = {k: max(n.bands for n in notices if n.width == k) for k in widths}
    found = found.selectExpr(
        "*", *[f"transform(sh{k}, h -> xxhash64(h, {j})) as band{k}_{j}" for k in widths for j in range(bands[k])]
    )
    candidates = []
    for k, size in sorted({(n.width, n.size) for n in notices}):
        own = [n for n in notices if (n.width, n.size) == (k, size)]
        agrees = []
        for j in range(max(n.bands for n in own)):
            least = sorted({min(band_hash(shingle_hash(s), j) for s in n.shingles) for n in own if j < n.bands})
            agrees.append(f"array_min(slice(band{k}_{j}, s, {own[0].window})) in ({_longs(least)})")
        candidates.append(
            f"case when size(sh{k}) > 0 then filter(sequence(1, size(sh{k}), {own[0].stride}), s -> {' or '.join(agrees)})"
            f" else {none.format('int')} end as at{k}_{size}"
        )
    found = found.selectExpr("doc_id", *[f"sh{k}" for k in widths], *candidates)
    held = []
    for n in notices:
        window = f"slice(sh{n.width}, s, {n.window})"

        def hashes(own: list[str]) -> str:
            return f"array({_longs([shingle_hash(s) for s in own])})"

        tests = [f"size(array_intersect({window}, {hashes(n.shingles)})) >= {n.need}"]
        tests += [f"arrays_overlap({window}, {hashes(own)})" for own in n.telling]
        held.append(
            f"case when exists(at{n.width}_{n.size}, s -> {' and '.join(tests)}) then"
            f" named_struct('id', '{n.license_id}', 'free', {str(n.family == 'permissive').lower()}) end"
        )
    found = found.selectExpr("doc_id", f"array_distinct(array_compact(array({', '.join(held)}))) as held")
    return found.select(
        "doc_id",
        F.size("held").cast("bigint").alias("n_licenses"),
        F.array_join(F.array_sort("held.id"), ",").alias("licenses"),
        F.expr(
            f"exists(held, x -> not x.free and x.id != '{RESERVED}')"
            f" or size(held) > 0 and forall(held, x -> x.id = '{RESERVED}')"
        ).alias("restricted"),
    )


def sql(given: list[tuple[str, ...]] = NOTICES) -> str:
    """The same by DuckDB: every window of every document against every notice, without bands."""
    notices = [Notice(*n) for n in given]
    rows = ", ".join(
        f"('{n.license_id}', {str(n.family == 'permissive').lower()}, {n.width}, {n.window}, {n.stride}, {n.need},"
        f" {n.shingles!r}, {n.telling!r}::varchar[][])"
        for n in notices
    )
    widths = sorted({n.width for n in notices})
    lists = ", ".join(
        f"case when len(w) < {k} then [] else"
        f" list_transform(range(1, len(w) - {k - 2}), lambda i: array_to_string(w[i : i + {k - 1}], ' ')) end as sh{k}"
        for k in widths
    )
    chosen = "case width " + " ".join(f"when {k} then sh{k}" for k in widths) + " end"
    return f"""
with notices(id, free, width, size, stride, need, own, telling) as (values {rows}),
d as (select row_number() over () as r, doc_id,
             list_filter(string_split_regex(lower(coalesce(text, '')), '[^a-z0-9]+'), lambda x: x <> '') as w
      from documents),
s as (select r, doc_id, {lists} from d),
t as (select r, id, free, size, stride, need, own, telling, {chosen} as sh from s, notices
      where list_has_any({chosen}, own)),
m as (select distinct r, id, free
      from t, lateral (select unnest(range(1, len(sh) + 1, stride)) as k)
      where len(list_intersect(sh[k : k + size - 1], own)) >= need
        and len(list_filter(telling, lambda g: not list_has_any(sh[k : k + size - 1], g))) = 0),
g as (select r, count(distinct id) as n, string_agg(distinct id, ',' order by id) as ids,
             bool_or(not free and id <> '{RESERVED}') or bool_and(id = '{RESERVED}') as held
      from m group by r)
select doc_id, coalesce(n, 0) as n_licenses, coalesce(ids, '') as licenses, coalesce(held, false) as restricted
from s left join g using (r)
"""
