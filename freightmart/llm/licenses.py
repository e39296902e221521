"""License scan: sparse TF-IDF cosine of lines, runs of lines and whole files to templates, then inheritance from the nearest directory.

Every line, run of neighbouring lines, paragraph and the whole of every text is compared with every statement, the whole
also with whole license texts. A file that a license makes up is a license file of its directory; a file without a license of its own has that of its nearest ancestor directory with one.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import cache
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .base import keep, steps

#: Statements and opening words of well-known licenses.
_SAID: Mapping[str, tuple[str, ...]] = {
    "MIT": ("The MIT License", "Released under the MIT License.", "Licensed under the MIT License.", "Distributed under the terms of the MIT license.",
            "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
            "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions:"),
    "Apache": ("Licensed under the Apache License.",),
    "Apache-1.1": ("Licensed under the Apache License, Version 1.1.", "The Apache Software License, Version 1.1"),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", "Apache License Version 2.0, January 2004",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                   "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
                   "either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    "BSD": ("Licensed under the BSD License.", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    "0BSD": ("Licensed under the BSD Zero Clause License.", "Zero-Clause BSD",
             "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    "BSD-2-Clause": ("Licensed under the BSD 2-Clause License.", "Licensed under the Simplified BSD License."),
    "BSD-3-Clause": ("Licensed under the BSD 3-Clause License.", "Licensed under the New BSD License."),
    "BSD-4-Clause": ("Licensed under the BSD 4-Clause License.", "Licensed under the Original BSD License."),
    "ISC": ("The ISC License", "Licensed under the ISC License.",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
            "above copyright notice and this permission notice appear in all copies."),
    "MPL": ("Licensed under the Mozilla Public License.",),
    "MPL-1.1": ("Licensed under the Mozilla Public License, Version 1.1.", "Mozilla Public License Version 1.1",
                "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this file except in "
                "compliance with the License."),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License, Version 2.0.",
                "Mozilla Public License Version 2.0"),
    "Unlicense": ("Released under the Unlicense.", "Licensed under the Unlicense.", "The Unlicense", "This is free and unencumbered software released into the public domain."),
    "Zlib": ("The zlib License", "Licensed under the zlib License.",
             "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising "
             "from the use of this software."),
    "BSL-1.0": ("Licensed under the Boost Software License, Version 1.0.", "Distributed under the Boost Software License, Version 1.0."),
    "EPL": ("Licensed under the Eclipse Public License.",),
    "EPL-1.0": ("Licensed under the Eclipse Public License, Version 1.0.", "Eclipse Public License - v 1.0"),
    "EPL-2.0": ("Licensed under the Eclipse Public License, Version 2.0.", "Eclipse Public License - v 2.0",
                "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    "Artistic-2.0": ("Licensed under the Artistic License 2.0.", "The Artistic License 2.0"),
    "Artistic-1.0": ("Licensed under the Artistic License.", "Licensed under the Artistic License 1.0."),
    "CC0-1.0": ("Licensed under CC0 1.0.", "This work is dedicated to the public domain under CC0 1.0 Universal.", "Creative Commons CC0 1.0 Universal"),
    "CC-BY": ("Licensed under CC BY.", "This work is licensed under a Creative Commons Attribution License."),
    "CC-BY-NC": ("Licensed under CC BY-NC.", "This work is licensed under a Creative Commons Attribution-NonCommercial License."),
    "CC-BY-SA": ("Licensed under CC BY-SA.", "This work is licensed under a Creative Commons Attribution-ShareAlike License."),
}
#: The GNU licenses: by their names, short forms and versions; a statement without a version names the family alone.
_GNU: Mapping[str, tuple[str, tuple[str, ...]]] = {
    "GPL": ("GNU General Public License", ("1", "2", "3")),
    "LGPL": ("GNU Lesser General Public License", ("2.1", "3")),
    "AGPL": ("GNU Affero General Public License", ("3",)),
    "GFDL": ("GNU Free Documentation License", ("1.1", "1.2", "1.3")),
}
_GNU_DATES = {"GPL 1": ", February 1989", "GPL 2": ", June 1991", "GPL 3": ", 29 June 2007", "LGPL 2.1": ", February 1999", "LGPL 3": ", 29 June 2007",
              "AGPL 3": ", 19 November 2007", "GFDL 1.1": ", March 2000", "GFDL 1.2": ", November 2002", "GFDL 1.3": ", 3 November 2008"}
_CC = {"BY": "Attribution", "BY-NC": "Attribution-NonCommercial", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives",
       "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
#: A statement that grants nothing: a file with it and no license inherits none.
RESERVED = "All-Rights-Reserved"


def _templates() -> dict[str, tuple[str, ...]]:
    out = {name: list(texts) for name, texts in _SAID.items()}
    for short, (full, versions) in _GNU.items():
        free = f"{'This library' if short == 'LGPL' else 'This program'} is free software: you can redistribute it and/or modify it under the terms of the {full}"
        out[short] = [f"This work is licensed under the {full}.", f"Licensed under the {short}.", *([free] if short != "GFDL" else [])]
        for version in versions:
            made = out[f"{short}-{version}" + ".0" * ("." not in version)] = [
                f"This work is licensed under the {full}, version {version}.", f"Licensed under the {full}, version {version}.",
                f"This work is licensed under the {full}, version {version} or later.", f"{full} version {version}",
                f"Licensed under the {short}, version {version}.", f"Licensed under the {short}v{version}.", f"Licensed under the {short}-{version}.",
                f"{full} Version {version}{_GNU_DATES[f'{short} {version}']}"]
            if short != "GFDL":
                published = f"{free} as published by the Free Software Foundation"
                made += [f"{published}, either version {version} of the License, or (at your option) any later version. {free[:12]} is distributed in the hope "
                         "that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
                         f"PURPOSE. See the {full} for more details. You should have received a copy of the {full} along with {free[:12].lower()}. If not, see "
                         "<https://www.gnu.org/licenses/>.", f"{published}, either version {version} of the License, or (at your option) any later version.", f"{published}, version {version}.",
                         f"{published}; version {version} of the License."]
    out["LGPL-2.0"] = ["This work is licensed under the GNU Library General Public License, version 2.", "GNU Library General Public License Version 2, June 1991",
                       "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library General Public License as "
                       "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."]
    for short, full in _CC.items():
        for version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            kind = "International" if version == "4.0" else "Unported" if version == "3.0" else "Generic"
            out[f"CC-{short}-{version}"] = [f"Licensed under CC {short} {version}.", f"This work is licensed under a Creative Commons {full} {version} License.",
                                            f"This work is licensed under a Creative Commons {full} {version} {kind} License."]
    for name, made in out.items():
        made.append(f"SPDX-License-Identifier: {name}")
        if name[:3] in ("GPL", "LGP", "AGP", "GFD") and "-" in name:
            made += [f"SPDX-License-Identifier: {name}-only", f"SPDX-License-Identifier: {name}-or-later"]
    out[RESERVED] = ["All rights reserved."]
    return {name: tuple(texts) for name, texts in out.items()}


TEMPLATES: Mapping[str, tuple[str, ...]] = _templates()
#: Licenses named without their version or kind: they count where no statement names one with it.
FAMILIES = frozenset({"Apache", "BSD", "MPL", "EPL", "GPL", "LGPL", "AGPL", "GFDL", "CC-BY", "CC-BY-NC", "CC-BY-SA"})
#: Words that make another license: a statement has all of these that its template has, and no other. The same goes for
#: the version: a template's one-digit numbers must be there.
DECISIVE = ("lesser", "affero", "noncommercial", "nc", "sharealike", "sa", "noderivatives", "noderivs", "nd", "spdx")
DIGITS = tuple("0123456789")
#: Cosine from which a line or file states a license, and share of a file's words that such lines make up in a license file.
STATES, LICENSE_FILE = 0.8, 0.5
#: Lines of a run at most (paragraphs have no bound), and the part that known words must make up of the length of the
#: vector of each of its lines: below it a run would hardly come to STATES.
RUN, NEAR = 12, 0.5


@cache
def license_texts() -> dict[str, tuple[str, ...]]:
    """Whole license texts by name; read by the driver, the tasks get their vectors."""
    folder = resources.files(__package__).joinpath("license_texts")
    return {f.name.removesuffix(".txt"): (f.read_text(encoding="utf-8"),) for f in sorted(folder.iterdir(), key=lambda f: f.name) if f.name.endswith(".txt")}


def terms(texts: W.Texts) -> tuple[W.Words, np.ndarray]:
    """Runs of letters and digits, A-Z in lower case, and their hashes."""
    data = W.lower(texts.data)
    found = W.words(texts, W.within(data, 97, 122) | W.within(data, 48, 57) | (data >= 128))
    return found, W.hashes(data, found.start, found.end)


def _hashed(text: str) -> np.ndarray:
    return terms(W.Texts.of(pa.array([text])))[1]


@dataclass
class Templates:
    """Sorted term hashes with their inverse document frequencies, and unit vectors (terms, templates)."""

    names: list[str]
    term: np.ndarray
    idf: np.ndarray
    weight: np.ndarray
    rare: float
    rank: np.ndarray  # of each template: 0 a license, 1 only its family, 2 reserved rights
    special: np.ndarray  # hashes of DECISIVE and DIGITS
    has: np.ndarray  # which of them each template has: (special, templates)

    @staticmethod
    def of(templates: Mapping[str, tuple[str, ...]], whole: bool = False) -> Templates:
        """``whole``: of license texts, which are told apart by their cosine alone."""
        names = [name for name, texts in templates.items() for _ in texts]
        texts = W.Texts.of(pa.array([t for group in templates.values() for t in group]))
        found, hashed = terms(texts)
        term, at = np.unique(hashed, return_inverse=True)
        counts = np.zeros((len(term), texts.rows))
        np.add.at(counts, (at, found.row), 1)
        idf = np.log((1 + texts.rows) / (1 + (counts > 0).sum(axis=1))) + 1
        weight = counts * idf[:, None]
        special = np.concatenate([_hashed(w) for w in (*DECISIVE, *DIGITS)])
        has = np.stack([np.isin(special, hashed[found.row == i]) for i in range(texts.rows)], axis=1)
        if whole:
            special, has = special[:0], has[:0]
        rank = np.array([2 if n == RESERVED else int(n in FAMILIES) for n in names])
        return Templates(names, term, idf, weight / np.linalg.norm(weight, axis=0), float(np.log(1 + texts.rows) + 1), rank, special, has)

    def cosines(self, unit: np.ndarray, hashed: np.ndarray, units: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best cosine, its template, and the share of known words in the vector's length, for each unit of text; words of no template weigh as much as the rarest can.

        Only units with a template's word can be like one, the others are not summed up. Templates with other decisive
        words or another version than the unit are left out; what a unit states is its best template of the first rank.
        """
        place = np.minimum(np.searchsorted(self.term, hashed), len(self.term) - 1)
        known = self.term[place] == hashed
        use = (np.bincount(unit[known], minlength=units) > 0)[unit]
        unit, hashed, place, known = unit[use], hashed[use], place[use], known[use]
        order = np.lexsort((hashed, unit))
        unit, hashed, place, known = unit[order], hashed[order], place[order], known[order]
        first = np.ones(len(unit), bool)
        first[1:] = (unit[1:] != unit[:-1]) | (hashed[1:] != hashed[:-1])
        at = np.flatnonzero(first)
        count = np.diff(np.append(at, len(unit)))
        unit, hashed, place, known = unit[at], hashed[at], place[at], known[at]
        value = count * np.where(known, self.idf[place], self.rare)
        norm = np.sqrt(np.bincount(unit, value**2, units))
        # what a unit's known words alone weigh bounds its cosine: only promising units meet the templates
        inside = np.sqrt(np.bincount(unit[known], value[known] ** 2, units))
        promising = (inside >= STATES * norm) & (norm > 0)
        best, which = np.zeros(units), np.zeros(units, np.int64)
        pick = known & promising[unit]
        ids, row = np.unique(unit[pick], return_inverse=True)
        if len(ids):
            dots = np.zeros((len(ids), self.weight.shape[1]))
            np.add.at(dots, row, value[pick][:, None] * self.weight[place[pick]])
            cosine = dots / norm[ids][:, None]
            of, n = np.searchsorted(ids, unit).clip(max=len(ids) - 1), len(DECISIVE)
            there = np.zeros((len(ids), len(self.special)))
            for i, word in enumerate(self.special):
                at = of[hashed == word]
                there[at[np.isin(ids[at], unit[hashed == word])], i] = 1
            lacks = (1 - there) @ self.has + there[:, :n] @ (1 - self.has[:n].astype(float))
            # one rare word, "mit", weighs nearly as much as a short statement with it: more than half of the words must be there
            shared = np.zeros(dots.shape)
            np.add.at(shared, row, self.weight[place[pick]] > 0)
            cosine[(lacks > 0) | (2 * shared <= (self.weight > 0).sum(axis=0))] = 0
            at = (cosine + np.where(cosine >= STATES, 2 * (3 - self.rank), 0)).argmax(axis=1)
            best[ids], which[ids] = cosine[np.arange(len(ids)), at], at
        return best, which, inside / np.where(norm > 0, norm, 1)


def runs(lines: W.Words, words: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First lines and lines behind the last of all runs of 2 to RUN near lines, and of the paragraphs that hold one.

    Lines without words are in a run, but not counted, and end a paragraph; so do empty ones.
    """
    full = np.flatnonzero(words > 0)
    if not len(full):
        return full, full
    row = lines.row[full]
    breaks = np.ones(len(full), bool)
    breaks[1:] = (row[1:] != row[:-1]) | ~near[full[1:]] | ~near[full[:-1]]
    run = np.cumsum(breaks)
    begin, end = [], []
    for n in range(2, RUN + 1):
        at = np.flatnonzero(run[n - 1:] == run[:len(run) - n + 1]) if len(run) >= n else full[:0]
        if not len(at):
            break
        begin.append(full[at])
        end.append(full[at + n - 1] + 1)
    breaks[1:] = (row[1:] != row[:-1]) | (full[1:] != full[:-1] + 1) | (lines.start[full[1:]] - lines.end[full[:-1]] > 1)
    first = np.flatnonzero(breaks)
    holds = (np.add.reduceat(near[full].astype(np.int64), first) > 0) & (np.diff(np.append(first, len(full))) > 1)
    begin.append(full[first[holds]])
    end.append(full[np.append(first, len(full))[1:][holds] - 1] + 1)
    return np.concatenate(begin), np.concatenate(end)


def stated(files: DataFrame, templates: Mapping[str, tuple[str, ...]] = TEMPLATES, texts_of: Mapping[str, tuple[str, ...]] | None = None) -> DataFrame:
    """The files' other columns with license (or null), cosine, and covered: the share of words in lines that state one,
    1 if the whole text is like a statement or a license text."""
    names = [c for c in files.columns if c != "text"]
    known = Templates.of({**templates, RESERVED: TEMPLATES[RESERVED]})
    full = Templates.of(license_texts() if texts_of is None else texts_of, whole=True)
    all_names, all_ranks = [*known.names, *full.names], np.concatenate([known.rank, np.full(len(full.names), -1)])
    reserved, phrase = known.names.index(RESERVED), _hashed(TEMPLATES[RESERVED][0])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, len(names)):
            texts = W.Texts.of(batch.column(len(names)))
            found, hashed = terms(texts)
            lines = W.words(texts, texts.data != 0x0A)
            line = np.searchsorted(lines.start, found.start, "right") - 1
            n = len(lines.start)
            score, which, share = known.cosines(line, hashed, n)
            upto = np.searchsorted(line, np.arange(n + 1))
            begin, end = runs(lines, np.diff(upto), share >= NEAR)
            size = upto[end] - upto[begin]
            at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(upto[begin], size)
            run_score, run_which, _ = known.cosines(np.repeat(np.arange(len(begin)), size), hashed[at], len(begin))
            whole, whole_which, _ = known.cosines(found.row, hashed, texts.rows)
            text, text_which, _ = full.cosines(found.row, hashed, texts.rows)
            words = np.bincount(found.row, minlength=texts.rows)
            says = run_score >= STATES
            within = np.cumsum(np.bincount(begin[says], minlength=n + 1) - np.bincount(end[says], minlength=n + 1))[:n] > 0
            inside = (within | (score >= STATES))[line]
            # "all rights reserved" states its template wherever it stands in a sentence
            first = np.flatnonzero(np.all([hashed[i:len(hashed) - 2 + i] == h for i, h in enumerate(phrase)], axis=0)) if len(hashed) > 2 else np.zeros(0, np.int64)
            first = first[found.row[first] == found.row[first + 2]]
            inside[np.concatenate([first, first + 1, first + 2])] = True
            covered = np.bincount(found.row, inside, texts.rows) / np.maximum(words, 1)
            covered = np.where(np.maximum(whole, text) >= STATES, 1.0, covered)
            row = np.concatenate([lines.row, lines.row[begin], np.arange(texts.rows), np.arange(texts.rows), found.row[first]])
            score = np.concatenate([score, run_score, whole, text, np.ones(len(first))])
            which = np.concatenate([which, run_which, whole_which, text_which + len(known.names), np.full(len(first), reserved, np.int64)])
            # what states a license first, by rank, a whole license text before all; every row has the unit of its whole text
            order = np.lexsort((which, -score, np.where(score >= STATES, all_ranks[which], 3), row))
            top = order[np.searchsorted(row[order], np.arange(texts.rows))]
            best = score[top]
            names_of = [all_names[i] if b >= STATES else None for i, b in zip(which[top].tolist(), best.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(names_of, pa.string()), pa.array(best), pa.array(covered)],
                                             [*names, "license", "cosine", "covered"])

    kept = files.select(*(F.col(f"`{c}`") for c in names), F.col("text").cast("string").alias("text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields if f.name != "text")
    return kept.mapInArrow(made, f"{fields}, license string, cosine double, covered double")


def license_scan(files: DataFrame, templates: Mapping[str, tuple[str, ...]] = TEMPLATES) -> DataFrame:
    """License of every file (doc_id, path, text): doc_id, path, license, cosine, origin, directory.

    origin is ``own`` for a stated license, ``inherited`` for that of directory, the nearest ancestor with a license
    file (several in one directory: exact licenses before families, reserved rights last, then the highest cosine and
    the least path), else ``none``. A file that only reserves all rights has the license RESERVED of its own and inherits
    none; as a license file it stops what lies above its directory. Null and empty texts state nothing, a null path has no directory, repeated rows are rows of their own, other columns are not looked at, and an
    empty table gives no rows.
    """
    rows = files.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("path").cast("string").alias("path"), F.col("text").cast("string").alias("text"))
    # nulls group apart from the root, whose path is empty
    found = keep(stated(rows, templates).withColumn("dir", F.when(F.col("path").contains("/"), F.regexp_extract("path", r"(?s)^(.*)/", 1))
                                                    .when(F.col("path").isNotNull(), "")))
    rank = F.when(F.col("license") == RESERVED, 2).when(F.col("license").isin(*FAMILIES), 1).otherwise(0)
    order = F.struct(rank, -F.col("cosine"), F.col("path"), F.col("license"))
    own = (found.where((F.col("covered") >= LICENSE_FILE) & F.col("license").isNotNull() & F.col("dir").isNotNull())
           .groupBy("dir").agg(F.min_by("license", order).alias("dir_license")))
    # each directory once, with all its ancestors: as many rows as it is deep
    parts = F.split("dir", "/")
    ancestors = F.transform(F.sequence(F.lit(0), F.when(F.col("dir") == "", 0).otherwise(F.size(parts))), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    near = (found.where(F.col("dir").isNotNull()).select("dir").distinct()
            .select("dir", F.posexplode(ancestors).alias("depth", "up")).join(own.withColumnRenamed("dir", "up"), "up")
            .groupBy("dir").agg(F.max_by(F.struct("up", "dir_license"), "depth").alias("near"))
            .select("dir", F.col("near.up").alias("directory"), F.col("near.dir_license").alias("inherited")))
    # dealt out by another column first, so that both sides of the join are plain shuffles and a hot directory is split
    joined = found.join(near.repartition("directory"), "dir", "left")
    return joined.select(
        "doc_id", "path", F.coalesce("license", "inherited").alias("license"), F.when(F.col("license").isNotNull(), F.col("cosine")).alias("cosine"),
        F.when(F.col("license").isNotNull(), "own").when(F.col("inherited").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(F.col("license").isNull(), F.col("directory")).alias("directory"))
