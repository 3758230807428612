"""Licence scan: Dice coefficient over word bigrams of normalised text against templates.

Normalised: A-Z lower-cased, words are runs of letters a-z, digits and non-ASCII characters.
The units compared are every line, the whole text, and runs of words. Dice is ``2c / (a + b)`` over sets of
bigrams; it reaches the threshold ``t`` only where ``a`` lies between ``b * t / (2 - t)`` and
``b * (2 - t) / t``. These size bounds first drop units outside the range of every template and
then prune the templates a unit meets.

Bigrams of the remaining units meet the templates' bigrams in a broadcast equi-join (the
templates are a parameter of bounded size, checked), and shared bigrams are counted by a
partially aggregated ``groupBy`` per document and unit.

Runs find full licence texts, headers wrapped over lines (``TEXTS``) and notices inside a
paragraph: all words of a text count on, across its lines. The bigrams a text shares with a
template are collected with their positions, and those that follow each other form a block. In a
run a bigram that is not the template's counts each time it occurs, one that is counts once; so a
run that begins or ends inside a block never gains by leaving the rest of the block out, and runs
go from the first of one block to the last of another. A run that reaches the threshold shares
at least ``b * t / (2 - t)`` bigrams and holds at most ``b * (2 - 2t) / t`` others, which drops
nearly all starts at once; from each other start the blocks in reach are added one by one and the
end with the highest Dice stays (ties: the first). A copy of a licence is a block or a few, so the
work is linear in the number of copies.

Defined results: per row the best template over its units (highest Dice, ties to the
alphabetically first id), the number of units that reach the threshold, or NULL and 0; runs that
overlap count as one unit, those that touch a counted line as none. Two whole copies side by side
are two units; where words inside them were changed, a run from the second half of one to the
first half of the next may join them. NULL,
empty and one-word texts match nothing. Rows equal in id and text are counted together and
all get the result. Columns of other names are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import lower_ascii, text_id

#: Short notices by which works state their licence (public licence texts). Fixed values.
TEMPLATES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Licensed under the BSD 2-Clause License.",
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License.",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "This work is dedicated to the public domain under CC0 1.0.",
    "EPL-2.0": "This program is made available under the terms of the Eclipse Public License 2.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Released under the ISC License.",
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
#: Full texts of short licences and the headers of long ones, without names and years (public licence texts). Fixed values.
_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."
    " IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,"
    " WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
    " 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
    " 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_END = (
    " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY"
    " AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES"
    " (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,"
    " WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_NAME = " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_APACHE = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"
    " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS,"
    " WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."
)


def _gnu(name: str, version: str) -> tuple[str, str]:
    """The header of a GNU licence in its two forms: or any later version, and this version only."""
    start = f"This program is free software; you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation; "
    end = (
        f" This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
        f" See the GNU {name} for more details. You should have received a copy of the GNU {name} along with this program. If not, see http://www.gnu.org/licenses/."
    )
    return f"{start}either version {version} of the License, or (at your option) any later version.{end}", f"{start}version {version} of the License.{end}"


TEXTS = {
    "AGPL-3.0": _gnu("Affero General Public License", "3"),
    "Apache-2.0": (_APACHE,),
    "BSD-2-Clause": (_BSD + _BSD_END,),
    "BSD-3-Clause": (_BSD + _BSD_NAME + _BSD_END,),
    "BSL-1.0": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use,"
        " reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so,"
        " all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be"
        " included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable"
        " object code generated by a source language processor. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF"
        " MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER"
        " LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "GPL-2.0": _gnu("General Public License", "2"),
    "GPL-3.0": _gnu("General Public License", "3"),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice"
        " appear in all copies. " + _AS_IS,
    ),
    "LGPL-2.1": _gnu("Lesser General Public License", "2.1"),
    "LGPL-3.0": _gnu("Lesser General Public License", "3"),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction,"
        " including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished"
        " to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
        " THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND"
        " NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,"
        " OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as"
        " a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all"
        " copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this"
        " dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF"
        " ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR"
        " ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
}
THRESHOLD = 0.8
#: Templates are broadcast; more of them are refused.
MAX_TEMPLATES = 10_000

_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _bigrams(words: Column) -> Column:
    """Distinct word bigrams; none for fewer than two words."""
    n = F.size(words) - 1
    pairs = F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.when(n >= 1, F.array_distinct(pairs)).otherwise(F.array().cast("array<string>"))


def _words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(text), _BREAK), "")


def _template_bigrams(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """``(t_bigram, ts)``: per bigram the templates that hold it, as structs (license, b)."""
    known = spark.createDataFrame(sorted(templates.items()), "license string, template string")
    sized = known.select("license", _words(F.col("template")).alias("ws")).select("license", _bigrams(F.col("ws")).alias("bs"))
    pairs = sized.select("license", F.size("bs").alias("b"), F.explode("bs").alias("t_bigram"))
    return pairs.groupBy("t_bigram").agg(F.collect_list(F.struct("license", "b")).alias("ts"))


def _runs(rows: DataFrame, templates: list[tuple[str, str]], threshold: float) -> DataFrame:
    """``(id, tid, license, dice, run)``: runs of words that reach the threshold; ``run`` is (lo, hi, l1, l2), positions of bigrams and lines."""
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    known = rows.sparkSession.createDataFrame([(i, *t) for i, t in enumerate(templates)], "t int, license string, template string")
    sized = known.select("t", "license", _bigrams(_words(F.col("template"))).alias("bs"))
    pairs = sized.select("t", "license", F.size("bs").alias("b"), F.explode("bs").alias("t_bigram"))
    known = pairs.groupBy("t_bigram").agg(F.collect_list(F.struct("t", "license", "b")).alias("ts"))

    lines = F.transform(F.split("txt", "\n"), _words)
    line_of = F.flatten(F.transform("ls", lambda x, i: F.array_repeat(i, F.size(x))))
    n = F.size("ws") - 1
    words = F.zip_with(F.slice("ws", 1, n), F.slice("ws", 2, n), lambda a, b: F.concat(a, F.lit(" "), b))
    numbered = F.when(n >= 1, F.zip_with(words, F.slice(line_of, 1, n), lambda w, i: F.struct(w.alias("w"), i.alias("l"))))
    met = (
        rows.select("id", "tid", lines.alias("ls"))
        .select("id", "tid", "ls", F.flatten("ls").alias("ws"))
        .select("id", "tid", F.posexplode(numbered).alias("p", "x"))
        .select("id", "tid", "p", F.col("x.w").alias("bigram"), F.col("x.l").alias("l"))
        .join(F.broadcast(known), F.col("bigram") == F.col("t_bigram"))
        .select("id", "tid", "p", "l", F.xxhash64("bigram").alias("g"), F.explode("ts").alias("t"))
    )
    need, others = F.ceil(F.col("t.b") * low - 1e-9).cast("int"), F.floor(F.col("t.b") * (high - 1) + 1e-9).cast("int")
    # repeated rows give the same positions again, hence the set
    hits = (
        met.groupBy("id", "tid", "t")
        .agg(F.array_sort(F.collect_set(F.struct("p", "l", "g"))).alias("hits"))
        .select("id", "tid", F.col("t.license").alias("license"), F.col("t.b").alias("b"), need.alias("need"), others.alias("others"), "hits")
        .filter(F.size("hits") >= F.col("need"))
    )
    # first hits of blocks; a position less its index is the number of other bigrams before it
    firsts = F.filter(F.sequence(F.lit(0), F.size("hits") - 1), lambda i: (i == 0) | (F.get("hits", i - 1)["p"] < F.get("hits", i)["p"] - 1))
    before = lambda i: F.get("hits", i)["p"] - i
    # blocks from which enough shared bigrams, equal or not, lie near enough
    near = F.filter(F.sequence(F.lit(0), F.size("firsts") - 1), lambda k: before(F.get("firsts", k) + F.col("need") - 1) - before(F.get("firsts", k)) <= F.col("others"))

    def block(first: Column, k: Column) -> Column:
        part = F.slice("hits", first + 1, F.coalesce(F.get("firsts", k + 1), F.size("hits")) - first)
        lo, hi = F.get(part, F.lit(0)), F.element_at(part, -1)
        ends = [lo["p"].alias("lo"), hi["p"].alias("hi"), lo["l"].alias("l1"), hi["l"].alias("l2")]
        return F.struct(*ends, (lo["p"] - first).alias("before"), F.array_distinct(part["g"]).alias("gs"))

    def longer(x: Column, e: Column) -> Column:
        """The run of ``x`` with block ``e`` added."""
        gs = F.array_union(x["gs"], e["gs"])
        return F.struct(gs.alias("gs"), F.size(gs).alias("shared"), (e["before"] - x["from"]).alias("other"), x["from"].alias("from"), e["hi"].alias("hi"), e["l2"].alias("l2"), x["best"].alias("best"))

    def better(x: Column) -> Column:
        dice = 2 * x["shared"].cast("double") / (x["shared"] + x["other"] + F.col("b"))
        this = F.struct(dice.alias("dice"), x["hi"].alias("hi"), x["l2"].alias("l2"))
        best = F.when(dice > x["best"]["dice"], this).otherwise(x["best"])
        return F.struct(x["gs"].alias("gs"), x["from"].alias("from"), best.alias("best"))

    none = F.struct(F.lit(0.0).alias("dice"), F.lit(-1).alias("hi"), F.lit(-1).alias("l2"))

    def reach(k: Column) -> Column:
        """Block ``k`` and those near enough; each further one follows at least one other bigram."""
        return F.filter(F.slice("blocks", k + 1, F.col("others") + 1), lambda e: e["before"] - F.get("blocks", k)["before"] <= F.col("others"))

    # blocks from which enough different shared bigrams lie near enough
    starts = F.filter("near", lambda k: F.size(F.array_distinct(F.flatten(F.transform(reach(k), lambda e: e["gs"])))) >= F.col("need"))

    def run(k: Column) -> Column:
        start = F.get("blocks", k)
        empty = F.struct(F.array().cast("array<bigint>").alias("gs"), start["before"].alias("from"), none.alias("best"))
        # one-element arrays name a value that is used several times
        step = lambda x, e: F.get(F.transform(F.array(longer(x, e)), better), F.lit(0))
        best = F.aggregate(reach(k), empty, step)["best"]
        return F.struct(best["dice"].alias("dice"), start["lo"].alias("lo"), best["hi"].alias("hi"), start["l1"].alias("l1"), best["l2"].alias("l2"))

    # the condition is part of a column: as a filter it would be pushed below and computed again
    blocks = F.when(F.size("near") > 0, F.transform("firsts", block))
    found = (
        hits.select("*", firsts.alias("firsts"))
        .select("*", near.alias("near"))
        .select("id", "tid", "license", "b", "need", "others", "near", blocks.alias("blocks"))
        .select("id", "tid", "license", F.explode(F.transform(starts, run)).alias("r"))
        .filter(F.col("r.dice") >= threshold)
    )
    return found.select("id", "tid", "license", F.col("r.dice").alias("dice"), F.struct("r.lo", "r.hi", "r.l1", "r.l2").alias("run"))


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: dict[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
    texts: dict[str, tuple[str, ...]] = TEXTS,
) -> DataFrame:
    """``(<id_col>, license, dice, n_units)``, one row per row of ``docs``."""
    in_runs = sorted([*templates.items(), *((k, v) for k, vs in texts.items() for v in vs)])
    if len(in_runs) > MAX_TEMPLATES:
        raise ValueError(f"{len(in_runs)} templates; they are broadcast, at most {MAX_TEMPLATES} are taken")
    known = _template_bigrams(docs.sparkSession, templates)
    bounds = known.select(F.explode("ts.b").alias("b")).agg(F.min("b").alias("lo"), F.max("b").alias("hi")).first()
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    least, most = (bounds.lo or 1) * low, (bounds.hi or 0) * high

    # unit 0 stands for the row itself, unit 1 is the whole text, the others are its lines
    lines = F.split("txt", "\n")
    units = F.concat(F.array(F.lit(None).cast("string"), F.col("txt")), F.when(F.size(lines) > 1, lines).otherwise(F.array().cast("array<string>")))
    rows = docs.select(F.col(id_col).alias("id"), text_id(F.col(text_col)).alias("tid"), F.coalesce(F.col(text_col), F.lit("")).alias("txt"))
    # a text has at least as many bigrams as different words but one, also counted over its start
    some = F.array_distinct(F.slice("ws", 1, 4 * int(most) + 8))
    # conditions are part of the columns: as filters they would be pushed below and compute the words again
    sized = (
        rows.select("id", "tid", F.posexplode(units).alias("u", "unit"))
        .select("id", "tid", "u", _words(F.col("unit")).alias("ws"))
        .select("id", "tid", "u", F.when(F.size(some) - 1 <= most, F.col("ws")).alias("ws"))
        .select("id", "tid", "u", _bigrams(F.col("ws")).alias("bs"))
        .select("id", "tid", "u", "bs", F.size("bs").alias("a"))
    )
    fits = (F.col("u") > 0) & F.col("a").between(least, most)
    pairs = sized.select("id", "tid", "u", "a", F.explode_outer(F.when(fits, F.col("bs"))).alias("bigram"))
    met = (
        pairs.join(F.broadcast(known), F.col("bigram") == F.col("t_bigram"), "left")
        .filter((F.col("u") == 0) | F.col("ts").isNotNull())
        .select("id", "tid", "u", "a", "bigram", F.explode_outer("ts").alias("t"))
        .select("id", "tid", "u", "a", "bigram", F.col("t.license").alias("license"), F.col("t.b").alias("b"))
        .filter((F.col("u") == 0) | F.col("a").between(F.col("b") * low, F.col("b") * high))
    )
    # repeated rows give the same bigrams again, hence the set; the row marks (unit 0) are counted
    shared = met.groupBy("id", "tid", "u", "a", "license", "b").agg(F.size(F.collect_set("bigram")).alias("c"), F.count("*").alias("n"))
    dice = F.when(F.col("u") > 0, 2 * F.col("c").cast("double") / (F.col("a") + F.col("b")))
    found = F.col("dice") >= threshold
    units = shared.select("id", "tid", "u", "license", "n", dice.alias("dice"), F.lit(None).cast("struct<lo: int, hi: int, l1: int, l2: int>").alias("run"))
    none = F.lit(None).cast("long")
    runs = _runs(rows, in_runs, threshold).select("id", "tid", F.lit(-1).alias("u"), "license", none.alias("n"), "dice", "run")
    best = (
        units.unionAll(runs)
        .groupBy("id", "tid")
        .agg(
            F.min(F.when(found, F.struct((-F.col("dice")).alias("d"), F.col("license").alias("l")))).alias("best"),
            F.collect_set(F.when(found & (F.col("u") > 0), F.col("u"))).alias("us"),
            F.array_sort(F.collect_set("run")).alias("runs"),
            F.max(F.when(F.col("u") == 0, F.col("n"))).alias("copies"),
        )
    )
    # unit 1 is the whole text, line i is unit i + 2
    touches = F.transform("runs", lambda r: F.struct(r["lo"].alias("lo"), r["hi"].alias("hi"), F.exists("us", lambda u: (u == 1) | (u - 2).between(r["l1"], r["l2"])).cast("int").alias("at")))

    def merge(x: Column, r: Column) -> Column:
        """Counts the groups of overlapping runs of which none touches a counted line."""
        new = r["lo"] > x["end"]
        at = F.when(new, r["at"]).otherwise(F.greatest(x["at"], r["at"]))
        return F.struct((x["n"] + F.when(new, 1 - at).otherwise(x["at"] - at)).alias("n"), F.greatest(x["end"], r["hi"]).alias("end"), at.alias("at"))

    merged = F.aggregate(touches, F.struct(F.lit(0).alias("n"), F.lit(-1).alias("end"), F.lit(0).alias("at")), merge)
    best = best.select("id", "tid", "best", "copies", (F.size("us") + merged["n"]).cast("long").alias("n_units"))
    return best.select(
        F.col("id").alias(id_col),
        F.col("best.l").alias("license"),
        (-F.col("best.d")).alias("dice"),
        "n_units",
        F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"),
    ).drop("copy")
