"""Licence scan: a trained classifier of paragraphs, confirmed by comparison with notices.

Paragraphs are neighbouring lines of a text that have a word. Each line is classified by itself, and where it has a licence
word also with its neighbours, as notices may be wrapped; neighbouring finds of a family are one. Word 1-grams and 2-grams, hashed to a sparse vector, go
to a multinomial logistic regression over the licence families and the class unknown. It is trained on the notices
below with their variations, and on a bounded sample of paragraphs without licence words as unknown. Half of that sample
calibrates the unknown class: a family is named only above the probability that hardly any of those reach.
The word pairs of the paragraph around a find are then compared with the notices of its family: a notice may be a small part of
a long line, and wrapped over AROUND lines each way. Only DataFrame functions run on executors.

Defined cases: a null or empty text has no paragraphs; rows are judged one by one, so repeated rows and null ids
give their own finds; an empty table gives no finds; the sample may be empty, and then notices of other families
alone train the classifier; columns other than id and text are not used.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from closeworks.llm import native

UNKNOWN = "unknown"
#: Notices by family; headers and the short licences are given by their paragraphs.
NOTICES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "This project is available under the Apache License 2.0.",
        "You may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
    ),
    "bsd": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted.",
        "Use of this source code is governed by a BSD-style license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    "cc0": (
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "This work is dedicated to the public domain under CC0 1.0.",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and modify it under the terms of the GNU General Public License.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "You can redistribute this library under the terms of the GNU Lesser General Public License.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
    ),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, Version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    "reserved": (
        "All rights reserved.",
        "Copyright 2024 by the author. All rights reserved.",
        "No part of this work may be reproduced without permission.",
    ),
}
#: Words that keep a paragraph out of the sample of the unknown class.
LICENCE_WORDS = "(?i)licen[sc]|copyright|copyleft|rights|permission|public domain|redistribut|\\bcc[ -]|\\bgpl|\\bmit\\b|\\bbsd|mozilla|apache"
#: In lower case each match of LICENCE_WORDS has one of these.
PARTS = ("licen", "right", "copyleft", "permission", "public domain", "redistribut", "cc ", "cc-", "gpl", "mit", "bsd", "mozilla", "apache")
FEATURES = 1 << 14
#: Documents whose paragraphs, up to PARAGRAPHS of them, train and calibrate the unknown class.
SAMPLE = 400
PARAGRAPHS = 4000
#: Share of calibrating paragraphs of the unknown class that may be above the threshold, and its least value.
FALSE_SHARE = 0.001
LEAST = 0.5
#: Share of the word pairs of a notice that the paragraph must have, or of the words of the line, and of the notice, that the other must have.
SIMILAR = 0.6
#: Lines before and after a line that are compared with the notices with it, and (before, after) of those it is classified with.
AROUND = 16
JOINED = ((1, 0), (0, 1), (1, 1), (2, 2))
MAX_ITER = 60
REGULAR = 1e-4


def words(paragraph: Column) -> Column:
    return F.array_remove(F.split(F.lower(paragraph), r"[^\p{L}\p{N}.]+|[.]+(?:[^\p{L}\p{N}]+|$)"), "")


def terms(paragraph: Column) -> Column:
    """Words and pairs of neighbouring words."""

    def of(found: Column) -> Column:
        after = F.slice(found, F.lit(2), F.size(found))
        pairs = F.zip_with(F.slice(found, F.lit(1), F.size(after)), after, lambda a, b: F.concat_ws(" ", a, b))
        return F.concat(found, pairs)

    return native.bind(words(paragraph), of)


def paragraphs(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, paragraph, line): the lines that have a word, numbered from 0 over all lines."""
    lines = F.split(native.whole(text), "\n", -1)
    found = docs.select(F.col(key), F.posexplode(lines).alias("paragraph", "line"))
    return found.where(F.col("line").rlike(r"[\p{L}\p{N}]"))


def _near(line: Column) -> Column:
    """Whether a line has a licence word. The pattern is slow, so that only lines with a part of one are matched."""
    some = native.bind(F.lower(line), lambda low: reduce(or_, (F.contains(low, F.lit(x)) for x in PARTS)))
    return some & line.rlike(LICENCE_WORDS)


def units(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, whole, place, own, line, around): what is classified, and the part of the paragraph around it.

    Each line that has a word is one; a line with a licence word is one again with its neighbours, as far as no line
    without a word is between.
    """
    split = F.transform(F.split(native.whole(text), "\n", -1), lambda x: F.when(x.rlike(r"[\p{L}\p{N}]"), x).otherwise(""))

    def placed(lines: Column) -> Column:
        def of(line: Column, i: Column) -> Column:
            first = F.greatest(i - AROUND, F.lit(0))
            up = F.substring_index(F.array_join(F.slice(lines, first + 1, i - first + 1), "\n"), "\n\n", -1)
            down = F.substring_index(F.array_join(F.slice(lines, i + 1, F.lit(AROUND + 1)), "\n"), "\n\n", 1)
            return F.struct(i.alias("place"), line.alias("line"), F.when(_near(line), F.struct(up.alias("up"), down.alias("down"))).alias("near"))

        return F.transform(lines, of)

    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("whole"), F.explode(native.bind(split, placed)).alias("r"))
    rows = rows.select("key", "whole", "r.*").where("line <> ''")
    up, after = F.col("near.up"), F.expr("substring(near.down, length(line) + 1)")
    joined = [F.concat(F.substring_index(up, "\n", -1 - b), F.substring_index(after, "\n", a + 1)) for b, a in JOINED]
    more = F.array_except(F.array(*joined), F.array("line"))
    each = F.when(F.col("near").isNull(), F.array("line")).otherwise(F.concat(F.array("line"), more))
    around = F.concat(up, after)
    return rows.select("key", "whole", "place", "line", around.alias("around"), F.posexplode(each).alias("unit", "part")).select(
        "key", "whole", "place", (F.col("unit") == 0).alias("own"), F.col("part").alias("line"), "around"
    )


def _notices(spark: SparkSession) -> DataFrame:
    """(family, line): each notice, whole, without its first or last words, and in other letter case."""
    rows = F.array(*(F.struct(F.lit(f).alias("family"), F.lit(t).alias("line")) for f, all_ in NOTICES.items() for t in all_))
    one = spark.range(1).select(F.explode(rows).alias("r")).select("r.*")
    cut = F.split("line", " ")
    forms = [
        F.col("line"),
        F.upper("line"),
        F.lower("line"),
        F.concat_ws(" ", F.slice(cut, F.lit(1), F.greatest(F.size(cut) - 1, F.lit(1)))),
        F.concat(F.lit("Notice: "), F.col("line")),
        F.concat(F.lit("Copyright 2020 Foo. "), F.col("line")),
        F.concat(F.col("line"), F.lit(" See the file for details.")),
        F.concat(F.lit("This text and its parts. "), F.col("line")),
    ]
    return one.select("family", F.explode(F.array(*forms)).alias("line"))


def _unknown(docs: DataFrame, text: str) -> DataFrame:
    """(line, held): a bounded sample of paragraphs without licence words; held ones calibrate."""
    texts = docs.select(F.col(text).alias("text")).where("text is not null").withColumn("key", F.xxhash64("text"))
    some = texts.join(F.broadcast(texts.select("key").distinct().orderBy("key").limit(SAMPLE)), "key", "left_semi")
    some = some.dropDuplicates(["key"])
    lines = paragraphs(some, "key", "text")
    lines = lines.where(~F.col("line").rlike(LICENCE_WORDS)).select("line").distinct()
    lines = lines.orderBy(F.xxhash64("line"), "line").limit(PARAGRAPHS)
    return lines.select("line", (F.pmod(F.xxhash64("line", F.lit("held")), F.lit(2)) == 1).alias("held"))


class Classifier:
    """The trained regression, its families and the calibrated threshold."""

    def __init__(self, model: LogisticRegressionModel, families: list[str], threshold: float):
        self.model, self.families, self.threshold = model, families, threshold

    def probabilities(self, lines: DataFrame) -> DataFrame:
        """The rows with the likeliest family other than unknown, and its probability."""
        hashed = HashingTF(numFeatures=FEATURES, inputCol="terms", outputCol="features", binary=True)
        scored = self.model.transform(hashed.transform(lines.withColumn("terms", terms(F.col("line")))))
        p = vector_to_array("probability")
        known = [F.struct(F.get(p, F.lit(k)).alias("p"), F.lit(f).alias("family")) for k, f in enumerate(self.families) if k]
        best = F.greatest(*known)
        scored = scored.withColumn("best", best)
        return scored.select(*lines.columns, F.col("best.family").alias("family"), F.col("best.p").alias("probability"))


def fit(docs: DataFrame, text: str = "text") -> Classifier:
    spark = docs.sparkSession
    families = [UNKNOWN, *sorted(NOTICES)]
    number = F.array_position(F.array(*(F.lit(f) for f in families)), F.col("family")) - 1
    sample = _unknown(docs, text).collect()  # at most PARAGRAPHS lines
    kept = [r["line"] for r in sample if not r["held"]]
    held = [r["line"] for r in sample if r["held"]]
    rows = _notices(spark).withColumn("label", number.cast("double")).select("line", "label")
    unknown = _lines(spark, kept).withColumn("label", F.lit(0.0))
    hashed = HashingTF(numFeatures=FEATURES, inputCol="terms", outputCol="features", binary=True)
    train = hashed.transform(rows.union(unknown).withColumn("terms", terms(F.col("line")))).select("features", "label")
    regression = LogisticRegression(maxIter=MAX_ITER, regParam=REGULAR, family="multinomial")
    # a class without rows still has its number, up to the last family
    model = regression.fit(train.coalesce(1))
    one = Classifier(model, families, LEAST)
    if held:
        cut = one.probabilities(_lines(spark, held)).agg(F.percentile("probability", F.lit(1 - FALSE_SHARE))).first()[0]
        one.threshold = max(LEAST, cut)
    return one


def _lines(spark: SparkSession, lines: list[str]) -> DataFrame:
    return spark.createDataFrame([(x,) for x in lines], "line string")


def _pairs(found: Column) -> Column:
    """Pairs of neighbouring words, each once."""
    after = F.slice(found, F.lit(2), F.size(found))
    return F.array_distinct(F.zip_with(F.slice(found, F.lit(1), F.size(after)), after, lambda a, b: F.concat_ws(" ", a, b)))


def _similarity(line: Column, around: Column, family: Column) -> Column:
    """For the best notice of the family the share of its word pairs that are around the line, or the least share of common words, of the line's and of the notice's."""

    def of(both: Column) -> Column:
        found = None
        for name, notices in sorted(NOTICES.items()):
            shares = []
            for notice in notices:
                theirs, pairs = F.array_distinct(words(F.lit(notice))), _pairs(words(F.lit(notice)))
                common = F.size(F.array_intersect(both["words"], theirs))
                shares.append(F.size(F.array_intersect(both["pairs"], pairs)) / F.size(pairs))
                shares.append(F.least(common / F.size(both["words"]), common / F.size(theirs)))
            best = F.greatest(*shares)
            found = F.when(family == name, best) if found is None else found.when(family == name, best)
        return found

    return native.bind(F.struct(F.array_distinct(words(line)).alias("words"), native.bind(words(around), _pairs).alias("pairs")), of)


def find_licences(docs: DataFrame, key: str = "doc_id", text: str = "text", classifier: Classifier | None = None) -> DataFrame:
    """One row per run of neighbouring lines that are taken for one licence: its first line, or the first that is one by itself, family, probability, similarity, and whether that confirms it."""
    model = classifier or fit(docs, text)
    scored = model.probabilities(units(docs, key, text))
    found = scored.where(F.col("probability") > model.threshold)
    found = found.withColumn("similarity", _similarity(F.col("line"), F.coalesce("around", "line"), F.col("family")))
    # a line is of one family, by itself if it can be; repeated rows find the same units again
    best = F.max(F.struct("own", "probability", "similarity", "family"))
    copies = F.count(F.lit(1)) / F.size(F.collect_set("line"))
    lines = found.groupBy("key", "whole", "place").agg(best.alias("best"), copies.cast("int").alias("copies"))
    lines = lines.select("key", "whole", "place", "best.*", "copies")
    number = F.row_number().over(Window.partitionBy("key", "whole", "family").orderBy("place"))
    runs = lines.withColumn("run", F.col("place") - number).groupBy("key", "whole", "family", "run")
    first = F.coalesce(F.min(F.when(F.col("own"), F.col("place"))), F.min("place")).alias("paragraph")
    one = runs.agg(first, *(F.max(n).alias(n) for n in ("probability", "similarity", "copies")))
    each = one.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return each.select(
        F.col("key").alias(key),
        "paragraph",
        "family",
        F.round("probability", 6).alias("probability"),
        F.round("similarity", 6).alias("similarity"),
        (F.col("similarity") >= SIMILAR).alias("confirmed"),
    )
