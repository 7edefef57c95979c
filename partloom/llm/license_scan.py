"""Licence scans with DataFrame functions only.

1. Texts are cut into notices: lines, and sentences within them, that hold a licence word; sentences that are wrapped over several
   lines, joined again; blocks of adjoining notices, joined; and the single names of an SPDX expression.
2. Each notice and each template is a sparse vector of words weighted by term frequency and inverse document
   frequency over the templates (a word that no template has weighs as the rarest); their cosines come from a join on words. The best template of
   a notice counts if its cosine is at least ``least``.
3. A file has the licence of its best notice; that all rights are reserved counts if it has no other. A file that is mostly notices, or is named as a licence file, speaks for its directory.
4. Files without a notice inherit from the nearest ancestor directory that has a licence: their ancestors are joined to
   the directories by path, and the deepest match wins.

Templates are a small table that the caller gives; it is broadcast after a count. Directories are broadcast while they are at
most ``BROADCAST_ROWS``; beyond, the join is a shuffle whose large partitions adaptive execution splits.

Defined results: null and empty texts have no notices; files without a path inherit nothing; equal cosines are decided by the
template's name, several licences of a directory by the higher cosine, then the name; repeated rows are scanned each; extra
columns are left out; empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from partloom.llm.common import shared_folder, stored

#: Directories, and template words, that are broadcast at most.
BROADCAST_ROWS = 100_000
#: Notices of common licences, as their texts ask to state them.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License, CC BY 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("proprietary", "Copyright. All rights reserved. No part may be reproduced without written permission."),
)
#: Names of SPDX identifiers, and of licences written out, with the licence they stand for.
TEMPLATES += tuple(
    (licence, f"SPDX-License-Identifier: {name}")
    for licence, names in {
        "Apache-2.0": "Apache-2.0", "MIT": "MIT", "GPL-2.0": "GPL-2.0 GPL-2.0-only GPL-2.0-or-later", "GPL-3.0": "GPL-3.0 GPL-3.0-only GPL-3.0-or-later", "LGPL-2.1": "LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later",
        "LGPL-3.0": "LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later", "AGPL-3.0": "AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later", "BSD-2-Clause": "BSD-2-Clause", "BSD-3-Clause": "BSD-3-Clause", "MPL-2.0": "MPL-2.0",
        "ISC": "ISC", "CC0-1.0": "CC0-1.0", "CC-BY-4.0": "CC-BY-4.0", "CC-BY-SA-4.0": "CC-BY-SA-4.0", "CC-BY-NC-4.0": "CC-BY-NC-4.0", "proprietary": "LicenseRef-Proprietary",
    }.items()
    for name in names.split()
) + (
    ("MIT", "MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions."),
    ("Apache-2.0", "Apache License, Version 2.0."),
    ("GPL-3.0", "GNU General Public License, version 3."),
    ("GPL-2.0", "GNU General Public License, version 2."),
    ("BSD-3-Clause", "BSD 3-Clause License."),
    ("proprietary", "All rights reserved."),
)
#: Whole texts of short public licences, paragraph by paragraph, and the headers that longer ones ask for.
TEMPLATES += (
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MIT", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("BSD-2-Clause", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote the original software. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. This notice may not be removed or altered from any source distribution."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at http://www.eclipse.org/legal/epl-2.0/"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work. CC0 1.0 Universal, public domain dedication."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
)
#: Fixed value: the licence that gives way to any other of the same file.
RESERVED = "proprietary"
#: Words that make a line a notice, and names of licence files.
NOTICE = r"(?i)licen[cs]|copyright|spdx|redistribut|public domain|rights reserved|permission (?:is|to use)|without warrant"
CUT = r"\n|(?<=[.!?;])\s+(?=[\p{Lu}])|(?=(?i:\ball rights reserved))"
SPDX = r"(?i)spdx-license-identifier:\s*([^\n]*)"
FILE_NAME = r"(?i)^(licen[cs]e|copying|notice|copyright)([._-].*)?$"


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TEMPLATES, "licence string, text string")


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*"), F.lit(0))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def units(files: DataFrame) -> DataFrame:
    """(row, from, to, line): lines and sentences, unwrapped sentences, blocks and SPDX names, with the first and last line or sentence that they hold. files: (row, text)."""
    pieces = files.where(F.col("text").rlike(NOTICE)).select("row", F.split("text", CUT).alias("p"))
    # a line goes on with the sentence before it if that is not ended
    each = F.transform("p", lambda x, i: F.struct(x.alias("line"), ((i > 0) & x.rlike(r"\S") & F.get("p", i - 1).rlike(r"[^.!?;:\s]\s*$")).alias("goes_on")))
    lines = pieces.select("row", F.posexplode(each).alias("at", "x")).select("row", "at", F.col("x.line").alias("line"), F.col("x.goes_on").alias("goes_on")).distinct()
    w = Window.partitionBy("row")
    placed = lines.withColumn("sentence", F.sum(F.when(F.col("goes_on"), 0).otherwise(1)).over(w.orderBy("at")))
    joined = lambda df, by: df.groupBy("row", by).agg(F.min("from").alias("from"), F.max("to").alias("to"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("from", "line"))), lambda s: s["line"]), " ").alias("line"))
    alone = placed.where(F.col("line").rlike(NOTICE)).select("row", F.col("at").alias("from"), F.col("at").alias("to"), "line")
    whole = joined(placed.select("row", "sentence", F.col("at").alias("from"), F.col("at").alias("to"), "line"), "sentence").where(F.col("line").rlike(NOTICE))
    # blank lines do not part the notices of a block
    filled = placed.where(F.col("line").rlike(r"[\p{L}\p{N}]")).groupBy("row", "sentence").agg(F.max(F.col("line").rlike(NOTICE)).alias("notice")).withColumn("n", F.row_number().over(w.orderBy("sentence")))
    runs = filled.where("notice").withColumn("block", F.col("n") - F.row_number().over(w.orderBy("sentence"))).select("row", "sentence", "block")
    blocks = joined(whole.join(runs, ["row", "sentence"]), "block")
    named = alone.select("row", "from", "to", F.explode(F.split(F.regexp_extract("line", SPDX, 1), r"[\s()]+")).alias("name")).where("name not in ('', 'OR', 'AND', 'WITH')")
    wide = whole.drop("sentence").unionByName(blocks.drop("block")).where(F.col("from") < F.col("to"))
    return alone.unionByName(wide).unionByName(named.select("row", "from", "to", F.concat(F.lit("SPDX-License-Identifier: "), "name").alias("line"))).distinct()


def notices(files: DataFrame, forms: DataFrame, least: float, folder: str) -> DataFrame:
    """(row, licence, cosine, from, to, n_terms) of the notices that a template explains. files: (row, text)."""
    every = stored(units(files).select("row", F.xxhash64("from", "to", "line").alias("at"), "from", "to", terms(F.col("line")).alias("terms")), folder, "units")
    held = every.select("row", "at", "terms")
    form = forms.select(F.xxhash64("licence", "text").alias("form"), "licence", F.explode(terms(F.col("text"))).alias("term"))
    n = forms.count()
    idf = form.groupBy("term").agg(F.log((1.0 + n) / (1.0 + F.count_distinct("form"))).alias("idf0")).select("term", (F.col("idf0") + 1).alias("idf"))
    rarest = F.lit(1.0) + F.log(F.lit((1.0 + n) / 2.0))
    weighed = form.groupBy("form", "licence", "term").agg(F.count(F.lit(1)).alias("tf")).join(idf, "term").select("form", "licence", "term", (F.col("tf") * F.col("idf")).alias("w"))
    norm = weighed.groupBy("form").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("form_norm"))
    vectors = _small(weighed.join(norm, "form").join(idf, "term").groupBy("term", "idf").agg(F.collect_list(F.struct("form", "licence", "w", "form_norm")).alias("forms")))
    words = held.select("row", "at", F.size("terms").alias("n_terms"), F.explode("terms").alias("term")).groupBy("row", "at", "n_terms", "term").agg(F.count(F.lit(1)).alias("tf"))
    joined = words.join(vectors, "term", "left").select("row", "at", "n_terms", (F.col("tf") * F.coalesce("idf", rarest)).alias("v"), "forms")
    by_form = joined.select("row", "at", "n_terms", "v", F.explode_outer("forms").alias("f"))
    lengths = joined.groupBy("row", "at").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"))
    dots = by_form.where("f is not null").groupBy("row", "at", "n_terms", "f.form", "f.licence", "f.form_norm").agg(F.sum(F.col("v") * F.col("f.w")).alias("dot"))
    cosine = dots.join(lengths, ["row", "at"]).select("row", "at", "n_terms", "licence", F.round(F.col("dot") / (F.col("norm") * F.col("form_norm")), 6).alias("cosine"))
    best = cosine.groupBy("row", "at", "n_terms").agg(F.min(F.struct((-F.col("cosine")).alias("minus"), "licence")).alias("b"))
    explained = best.select("row", "at", F.col("b.licence").alias("licence"), (-F.col("b.minus")).alias("cosine")).where(F.col("cosine") >= least)
    return explained.join(every.select("row", "at", "from", "to", F.size("terms").alias("n_terms")), ["row", "at"]).drop("at")


def scan(files: DataFrame, forms: DataFrame, id_col: str, path_col: str = "path", text_col: str = "text", least: float = 0.6, mostly: float = 0.5) -> DataFrame:
    """``least``: the cosine from which a template explains a notice; ``mostly``: the share of a file's words in explained notices from which the file speaks for its directory.

    One row for each file: id, path, ``licence`` (null: none found), ``origin`` (header, file or directory), ``cosine``, ``from_directory``, ``n_notices`` (lines and sentences that a template explains)."""
    folder = shared_folder(files.sparkSession)
    numbered = files.select(F.col(id_col).alias("id"), F.col(path_col).alias("path"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    numbered = numbered.withColumn("row", F.struct(F.xxhash64("id", "path", "text").alias("a"), F.xxhash64(F.lit(7), "text", "path", "id").alias("b")))  # the same for the same row in every pass
    found = stored(notices(numbered.select("row", "text").where("text <> ''"), forms, least, folder).distinct(), folder, "notices")
    weak = F.col("licence") == RESERVED
    best = found.groupBy("row").agg(F.min(F.struct(weak.alias("weak"), (-F.col("cosine")).alias("minus"), "licence")).alias("b"))
    # each line or sentence counts once, in however many units it stands
    share = F.col("n_terms") / (F.col("to") - F.col("from") + 1)
    told = found.select("row", F.explode(F.sequence("from", "to")).alias("at"), share.alias("n")).groupBy("row", "at").agg(F.max("n").alias("n")).groupBy("row").agg(F.count(F.lit(1)).alias("n_notices"), F.sum("n").alias("said"))
    own = best.join(told, "row")
    held = numbered.select("row", "id", "path", F.size(F.split(F.trim("text"), r"\s+")).alias("n_words")).join(own, "row", "left")
    name = F.element_at(F.split("path", "/"), -1)
    parent = F.when(F.instr("path", "/") > 0, F.regexp_replace("path", "/[^/]*$", "")).otherwise("")
    marked = held.select(
        "id", "path", F.col("b.licence").alias("own"), (-F.col("b.minus")).alias("own_cosine"), F.coalesce("n_notices", F.lit(0)).alias("n_notices"), parent.alias("parent"),
        (F.col("b").isNotNull() & (name.rlike(FILE_NAME) | (F.col("said") >= mostly * F.col("n_words")))).alias("speaks"),
    )
    marked = stored(marked, folder, "files")
    directories = marked.where("speaks and path is not null").groupBy(F.col("parent").alias("directory")).agg(F.min(F.struct((F.col("own") == RESERVED).alias("weak"), (-F.col("own_cosine")).alias("minus"), F.col("own").alias("licence"))).alias("b"))
    directories = _small(stored(directories.select("directory", F.col("b.licence").alias("licence"), (-F.col("b.minus")).alias("cosine")), folder, "directories"))
    pieces = F.split("parent", "/")
    ancestors = F.explode(F.transform(F.sequence(F.lit(0), F.size(pieces)), lambda k: F.when(k == 0, F.lit("")).otherwise(F.array_join(F.slice(pieces, 1, k), "/"))))
    parents = marked.where("own is null and path is not null").select("parent").distinct()
    met = parents.select("parent", ancestors.alias("directory")).join(directories, "directory")
    nearest = met.groupBy("parent").agg(F.max(F.struct(F.length("directory").alias("depth"), "directory", "licence", "cosine")).alias("i"))
    out = marked.join(nearest, "parent", "left")
    inherit = F.col("own").isNull() & F.col("path").isNotNull()
    return out.select(
        F.col("id").alias(id_col),
        "path",
        F.when(F.col("own").isNotNull(), F.col("own")).when(inherit, F.col("i.licence")).alias("licence"),
        F.when(F.col("speaks"), "file").when(F.col("own").isNotNull(), "header").when(inherit & F.col("i").isNotNull(), "directory").alias("origin"),
        F.when(F.col("own").isNotNull(), F.col("own_cosine")).when(inherit, F.col("i.cosine")).alias("cosine"),
        F.when(inherit, F.col("i.directory")).alias("from_directory"),
        F.col("n_notices").cast("long").alias("n_notices"),
    )
