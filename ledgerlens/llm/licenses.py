"""License notices in texts, in SQL: MinHash bands over overlapping word windows retrieve templates; exact shingle containment decides."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WINDOW, STRIDE = 12, 6
BANDS = 24
MOST_SHINGLES = 20_000
SHARE = 0.8

#: The one-line notices by which works name their license.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "Subject to the terms of the Mozilla Public License, version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("CC-BY-4.0", "Licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
)


#: The opening or header by which files carry a license; those of one family differ in a few words.
HEADERS = (
    ("MIT", "permission", (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:")),
    ("BSL-1.0", "permission", (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by "
        'this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the '
        "Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:")),
    ("ISC", None, (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies.")),
    ("Apache-2.0", None, (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at")),
    ("GPL-3.0", "gnu", (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
        "Software Foundation, either version 3 of the License, or (at your option) any later version.")),
    ("GPL-2.0", "gnu", (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
        "Software Foundation; either version 2 of the License, or (at your option) any later version.")),
    ("LGPL-3.0", "gnu", (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the "
        "Free Software Foundation, either version 3 of the License, or (at your option) any later version.")),
    ("LGPL-2.1", "gnu", (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the "
        "Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.")),
    ("AGPL-3.0", "gnu", (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the "
        "Free Software Foundation, either version 3 of the License, or (at your option) any later version.")),
    ("MPL-2.0", None, (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
        "You can obtain one at")),
    ("Unlicense", None, (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute "
        "this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.")),
    ("Zlib", None, (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from "
        "the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
        "redistribute it freely, subject to the following restrictions:")),
)


def notices(spark: SparkSession) -> DataFrame:
    """Templates of this module: one-line notices, then headers."""
    every = [(a, None, b) for a, b in NOTICES] + list(HEADERS)
    return spark.createDataFrame([(n, *row) for n, row in enumerate(every)], "template_id long, license string, family string, text string")


def _shingles(text: str) -> str:
    """Hashes of neighbouring word pairs (lower case, without leading and trailing punctuation); a lone word pairs with nothing."""
    ws = f"filter(split(lower(coalesce({text}, '')), '[^\\\\p{{L}}\\\\p{{N}}.-]+'), w -> w <> '')"
    return (
        f"transform(array(transform({ws}, w -> trim(BOTH '.-' FROM w))), ws -> IF(size(ws) = 0, array(), "
        "transform(sequence(0, greatest(size(ws) - 2, 0)), i -> xxhash64(ws[i], get(ws, i + 1)))))[0]"
    )


def _minima(shingles: str) -> str:
    """One band a hash function: (band, least hash of the shingles)."""
    return f"transform(sequence(1, {BANDS}), b -> named_struct('band', b, 'least', array_min(transform({shingles}, s -> xxhash64(s, b)))))"


def _windows(size: str) -> str:
    """Starts of overlapping windows over `size` shingles."""
    return f"IF({size} = 0, array(), sequence(0, greatest({size} - 1 - {WINDOW - STRIDE}, 0), {STRIDE}))"


def _blocks(sizes: list[tuple[int, int]], most: int) -> list[list[int]]:
    """Template ids in blocks of at most `most` shingles, or of one template."""
    blocks, room = [], 0
    for template, size in sizes:
        if not blocks or size > room:
            blocks.append([])
            room = most
        blocks[-1].append(template)
        room -= size
    return blocks


def _matches(hashed: DataFrame, known: DataFrame, share: float) -> DataFrame:
    """Places (id, license, family, template_id, width, start, containment) at which one block of templates matches."""
    vocabulary = [r[0] for r in known.select(F.explode("wanted")).distinct().collect()]
    literals = ", ".join(f"{v}L" if v != -(1 << 63) else "CAST(-9223372036854775808 AS BIGINT)" for v in vocabulary) or "NULL"
    table = F.broadcast(
        known.select("template_id", F.explode(F.expr(f"transform({_windows('size(`all`)')}, s -> slice(`all`, s + 1, {WINDOW}))")).alias("w"))
        .select("template_id", F.expr(f"inline({_minima('w')})")).distinct()
    )
    # places that hold a template's shingle, bound once for the windows that need hashing
    near = (
        f"transform(array(filter(sequence(0, size(s) - 1), i -> s[i] IN ({literals}))), hits -> array_distinct(flatten(transform(hits, "
        f"h -> filter(array(h - pmod(h, {STRIDE}), h - pmod(h, {STRIDE}) - {STRIDE}), w -> w >= 0)))))[0]"
    )
    windows = hashed.filter("size(s) > 0").select("id", "row", "s", F.explode(F.expr(near)).alias("start"))
    drawn = windows.select("id", "row", "s", "start", F.expr(f"inline({_minima(f'slice(s, start + 1, {WINDOW})')})"))
    met = drawn.join(table, ["band", "least"]).select("id", "row", "start", "template_id", "s")
    wanted = F.broadcast(known.select("template_id", "license", "family", "wanted"))
    inside = f"array_intersect(wanted, slice(s, greatest(start + 1 - size(wanted), 1), 2 * size(wanted) + {WINDOW}))"
    return (
        met.join(wanted, "template_id")
        .select("id", "row", "license", "family", "template_id", F.size("wanted").alias("width"), "start", F.expr(f"size({inside}) / size(wanted)").alias("containment"))
        .filter(F.col("containment") >= share)
    )


def scan_licenses(
    docs: DataFrame, templates: DataFrame, share: float = SHARE, id: str = "doc_id", text: str = "text", most_shingles: int = MOST_SHINGLES,
) -> DataFrame:
    """One row for each document and license found: id, license, containment, word (of the first match).

    A template matches where at least `share` of its distinct shingles stand within a window of the text as wide as the template and
    WINDOW more shingles. Texts and templates are cut to windows of WINDOW shingles, one every STRIDE; a band is one MinHash,
    so a text window that shares the share j of its shingles with a template window retrieves it with probability 1 - (1 - j)^BANDS. A
    notice of WINDOW - STRIDE shingles or more shares at least a third with some window: it is missed with probability 6e-5 at most,
    a shorter one of three at least with probability 2e-3. Windows without any shingle of a template share
    nothing and draw no hashes. Null and empty texts and templates match nothing; rows without id are reported with a null id.

    Templates of one `family` (an optional column) differ in a few words, such as a version. Of those that match one passage, the ones
    with the greatest containment count; a passage ends where the next match of its template is a template's width away.
    Templates are a reference table of any size, used in blocks of at most `most_shingles` shingles (or one template); a block is what is sent
    to the executors, and documents are scanned once for each.
    """
    family = F.col("family") if "family" in templates.columns else F.lit(None)
    known = templates.select(
        "template_id", "license", family.cast("string").alias("family"), F.expr(f"array_distinct({_shingles('text')})").alias("wanted"), F.expr(_shingles("text")).alias("all"),
    ).filter("size(wanted) > 0")
    sizes = [tuple(r) for r in known.groupBy("template_id").agg(F.sum(F.size("wanted"))).orderBy("template_id").collect()]
    # rows without id are told apart by their text
    hashed = docs.select(F.col(id).alias("id"), F.when(F.col(id).isNull(), F.xxhash64(text)).alias("row"), F.expr(_shingles(f"`{text}`")).alias("s"))
    found = None
    for block in _blocks(sizes, most_shingles) or [[]]:
        part = _matches(hashed, known.filter(F.col("template_id").isin(block)), share)
        found = part if found is None else found.unionByName(part)
    place = Window.partitionBy("id", "row", "start", "family")
    order = Window.partitionBy("id", "row", "template_id").orderBy("start")
    ranked = found.distinct().select(
        "*", (F.col("family").isNotNull() & (F.max("containment").over(place) > F.col("containment"))).alias("beaten"),
        F.coalesce(F.col("start") - F.lag("start").over(order) > F.col("width") + WINDOW, F.lit(True)).alias("opens"),
    )
    passages = ranked.withColumn("passage", F.sum(F.col("opens").cast("int")).over(order)).groupBy("id", "row", "license", "template_id", "passage").agg(
        F.max(F.struct("containment", "beaten")).alias("best"), F.min("start").alias("start")
    )
    return (
        passages.filter("NOT best.beaten").groupBy("id", "license").agg(F.max("best.containment").alias("containment"), F.min("start").cast("long").alias("word"))
        .withColumnRenamed("id", id)
    )
