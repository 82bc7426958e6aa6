"""Licence notices by ordered signature rules, with built-in functions only.

A text becomes its words (runs of other than ASCII punctuation, white space and controls; A-Z lower-cased) joined by one
space. Texts without any word that a form of notice needs stop there. In the others, windows are the longest runs of words that occur in
rules, so a notice of any length and place lies whole in one window, and windows don't touch; each distinct window meets the
rules whose own keyword it contains, at all their places. Of overlapping detections a span inside a longer one goes, and of
equal or crossing ones the rule of the better priority stays. The three base phrases are placed exactly over the whole text, and
their labels always stay.

Rules: every licence's names in the forms of notice that suit it, and clauses that stand in the licences' own texts. Null counts as
empty: no words, no labels, score 0; an empty table gives no rows. Repeated rows, with or without doc_id, are judged alike; rules that
meet at one place with one priority don't exist, and labels are listed once. Columns besides doc_id and text are left aside.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import own_text
from .native import lower_ascii

PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Fixed table: label, keyword, expression of the name in normalised words, SPDX identifier in normalised words.
FAMILIES = [
    ("mit", "mit", "mit(?: x11)?", "mit"),
    ("apache", "apache", "apache(?: software)?", "apache [12](?: [01])?"),
    ("agpl", "affero", "(?:gnu )?affero general public", "agpl [13](?: 0)?(?: only| or later)?"),
    ("lgpl", "lesser", "(?:gnu )?lesser general public", "lgpl [23](?: [01])?(?: only| or later)?"),
    ("lgpl", "library", "(?:gnu )?library general public", "lgpl 2 0(?: only| or later)?"),
    ("gpl", "general public", "(?:gnu )?general public", "gpl [123](?: 0)?(?: only| or later)?"),
    ("gpl", "gpl", "(?:gnu )?gpl(?: ?v?[123])?", "gpl [123] 0"),
    ("gfdl", "free documentation", "(?:gnu )?free documentation", "gfdl 1 [123](?: only| or later)?"),
    ("bsd-2", "bsd", "(?:2|two) clause bsd|simplified bsd|bsd 2 clause", "bsd 2 clause"),
    ("bsd-3", "bsd", "(?:3|three) clause bsd|new bsd|modified bsd|bsd 3 clause", "bsd 3 clause"),
    ("bsd-4", "bsd", "(?:4|four) clause bsd|original bsd|bsd 4 clause", "bsd 4 clause"),
    ("bsd", "bsd", "bsd", "0bsd"),
    ("mpl", "mozilla", "mozilla public", "mpl [12] [01]"),
    ("epl", "eclipse", "eclipse public", "epl [12] 0"),
    ("edl", "eclipse", "eclipse distribution", "edl 1 0"),
    ("cddl", "common development", "common development and distribution", "cddl 1 [01]"),
    ("cpl", "common public", "common public", "cpl 1 0"),
    ("eupl", "european union", "european union public", "eupl 1 [012]"),
    ("isc", "isc", "isc", "isc"),
    ("zlib", "zlib", "zlib(?: libpng)?", "zlib"),
    ("boost", "boost", "boost(?: software)?", "bsl 1 0"),
    ("artistic", "artistic", "(?:perl )?artistic", "artistic [12] 0"),
    ("unlicense", "unlicense", "unlicense", "unlicense"),
    ("wtfpl", "do what the", "do what the [a-z]+ you want to public", "wtfpl"),
    ("python", "python", "python(?: software foundation)?", "python 2 0"),
    ("ruby", "ruby", "ruby", "ruby"),
    ("php", "php", "php", "php 3 01?"),
    ("ofl", "open font", "(?:sil )?open font", "ofl 1 [01]"),
    ("ms-pl", "microsoft public", "microsoft public", "ms pl"),
    ("ms-rl", "microsoft reciprocal", "microsoft reciprocal", "ms rl"),
    ("odbl", "open database", "open database", "odbl 1 0"),
    ("odc-by", "open data commons", "open data commons attribution", "odc by 1 0"),
    ("cc0", "cc0", "cc0(?: 1 0)?(?: universal)?", "cc0 1 0"),
    ("cc-by-nc-sa", "c", "(?:cc|creative commons) (?:by|attribution) (?:nc|noncommercial) (?:sa|sharealike)(?: [1234] [05])?", "cc by nc sa [1234] [05]"),
    ("cc-by-nc-nd", "c", "(?:cc|creative commons) (?:by|attribution) (?:nc|noncommercial) (?:nd|noderivatives)(?: [1234] [05])?", "cc by nc nd [1234] [05]"),
    ("cc-by-nc", "by nc", "cc by nc(?: [1234] [05])?", "cc by nc [1234] [05]"),
    ("cc-by-nc", "noncommercial", "(?:cc|creative commons) attribution noncommercial(?: [1234] [05])?", "cc by nc [1234] [05]"),
    ("cc-by-sa", "by sa", "cc by sa(?: [1234] [05])?", "cc by sa [1234] [05]"),
    ("cc-by-sa", "sharealike", "(?:cc|creative commons) attribution sharealike(?: [1234] [05])?", "cc by sa [1234] [05]"),
    ("cc-by-nd", "by nd", "cc by nd(?: [1234] [05])?", "cc by nd [1234] [05]"),
    ("cc-by", "cc by", "cc by(?: [1234] [05])?", "cc by [1234] [05]"),
    ("cc-by", "creative commons", "creative commons attribution(?: [1234] [05])?", "cc by [1234] [05]"),
    ("cc", "creative commons", "creative commons", "cc"),
    ("public-domain", "public domain", "public domain", "public domain"),
    ("proprietary", "proprietary", "proprietary", "licenseref proprietary"),
]
#: Forms of notice, best first, with the confidence of each; N is the name, S the identifier.
FORMS = [
    ("spdx license identifier (?:S)", 1.0),
    ("licen[cs]ed under (?:the )?(?:terms of )?(?:the )?(?:N)(?: licen[cs]e)?(?: version)?(?: v?[0-9]+(?: [0-9]+)?)?", 0.98),
    ("(?:released|distributed|available|provided|published|redistributed) (?:[a-z]+ )?under (?:the )?(?:terms of )?(?:the )?(?:N)(?: licen[cs]e)?", 0.97),
    ("(?:subject to|covered by|governed by) (?:the )?(?:terms of )?(?:the )?(?:N)(?: licen[cs]e)?", 0.95),
    ("(?:dedicated|placed|released) (?:to|in|into) the (?:N)", 0.94),
    ("(?:N) licen[cs]e(?: agreement)?(?: version)?(?: v?[0-9]+(?: [0-9]+)?)?", 0.9),
    ("licen[cs]e (?:type )?(?:N)", 0.85),
]
#: Fixed table of clauses in normalised words that name their licence without its name, by label; each has the confidence 0.96.
CLAUSES = {
    "mit": ["permission is hereby granted free of charge to any person obtaining a copy of this software", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability"],
    "isc": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "the software is provided as is and the author disclaims all warranties"],
    "bsd": ["redistribution and use in source and binary forms with or without modification are permitted", "redistributions of source code must retain the above copyright notice", "redistributions in binary form must reproduce the above copyright notice"],
    "bsd-3": ["neither the name of the copyright holder nor the names of its contributors may be used to endorse", "neither the name of the organization nor the names of its contributors may be used to endorse"],
    "bsd-4": ["all advertising materials mentioning features or use of this software must display"],
    "apache": ["you may not use this file except in compliance with the license", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", "licensed to the apache software foundation"],
    "gpl": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "either version 2 of the license or at your option any later version", "either version 3 of the license or at your option any later version", "you should have received a copy of the gnu general public license"],
    "lgpl": ["this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license", "you should have received a copy of the gnu lesser general public license"],
    "agpl": ["you should have received a copy of the gnu affero general public license", "under the terms of the gnu affero general public license"],
    "mpl": ["this source code form is subject to the terms of the mozilla public license"],
    "epl": ["this program and the accompanying materials are made available under the terms of the eclipse public license"],
    "zlib": ["this software is provided as is without any express or implied warranty in no event will the authors be held liable", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"],
    "boost": ["permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"],
    "artistic": ["the intent of this document is to state the conditions under which a package may be copied"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
    "wtfpl": ["everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed"],
    "ofl": ["this font software is licensed under the sil open font license"],
    "gfdl": ["permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"],
    "cc0": ["the person who associated a work with this deed has dedicated the work to the public domain", "to the extent possible under law the author has waived all copyright and related"],
    "cc": ["this work is licensed under a creative commons"],
    "proprietary": ["unauthorized copying of this file via any medium is strictly prohibited", "all rights reserved no part of this publication may be reproduced", "proprietary and confidential"],
}
#: Forms by place in the table above that suit few licences: those of works given to the public.
GIVEN_AWAY, GIVES = ("public-domain", "cc0", "unlicense"), 4
#: What each form must contain, in the same order; a text or window without any of these meets no rule.
NEEDED = ["spdx license identifier", "licen[cs]ed under", "under", "subject to|covered by|governed by", "(?:dedicated|placed|released) (?:to|in|into) the", "licen[cs]e", "licen[cs]e"]
_CLAUSES = [c for own in CLAUSES.values() for c in own]
#: A clause passes by its first two words.
OPENS = list(dict.fromkeys(" ".join(c.split()[:2]) for c in _CLAUSES))
GATE = f"(?<![^ ])(?:{'|'.join(dict.fromkeys([*NEEDED, *OPENS]))})(?![^ ])"
ANY = f"(?i){GATE}"
#: Hits on either side, by place, that a hit is compared with: more than can overlap it, as a match has at most 31 words and at most four rules match from one on.
NEAR = 130


def rules() -> list[dict]:
    out = []
    for label, keyword, name, spdx in FAMILIES:
        for k, (form, sure) in enumerate(FORMS):
            if k == GIVES and label not in GIVEN_AWAY:
                continue
            body = form.replace("N", name) if "S)" not in form else form.replace("(?:S)", f"(?:{spdx})")
            out.append({"kw": keyword if "spdx" not in form else "spdx", "re": f"(?<![^ ]){body}(?![^ ])", "label": label, "sure": sure})
    for label, own in CLAUSES.items():
        out += [{"kw": c, "re": f"(?<![^ ]){c}(?![^ ])", "label": label, "sure": 0.96} for c in own]
    return [r | {"pri": i} for i, r in enumerate(out)]


def _window() -> str:
    """The longest runs of words that rules can match; free words of rules count where their next words follow."""
    own = set()
    for x in [f for f, _ in FORMS] + [y for _, _, name, spdx in FAMILIES for y in (name, spdx)]:
        own |= {w for w in re.sub(r"\(\?:|\)\??|\|", " ", x).split() if re.match("[a-z0-9]", w) and w not in ("N", "S")}
    word = f"(?:(?:{'|'.join(sorted(own, key=lambda w: (-len(w), w)))}|(?:gpl)?v?[0-9]+)(?![^ ])|[a-z]++(?= (?:under|you want to public)(?![^ ])))"
    one = f"(?:(?:{'|'.join(sorted(_CLAUSES, key=lambda c: (-len(c), c)))})(?![^ ])|{word})"
    return f"(?<![^ ]){one}(?: {one})*+"


WINDOW = _window()


def _spaces(x: Column) -> Column:
    return (F.char_length(x) - F.char_length(F.replace(x, F.lit(" "), F.lit("")))).cast("bigint")


def _detected(window: Column, table: Column) -> Column:
    """Rules that hold in a window, less those that others suppress."""
    rules_of = F.filter(table, lambda r: F.instr(window, r["kw"]) > 0)

    def places(r):
        """A struct for each match; what stands between matches and the matches add up to its place."""
        own = F.transform(F.regexp_extract_all(window, r["re"], F.lit(0)), F.char_length)
        steps = F.zip_with(F.slice(F.transform(F.split(window, r["re"], -1), F.char_length), 1, F.size(own)), own, lambda b, n: F.struct(b.alias("b"), n.alias("n")))
        none = F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<s:int,n:int>>").alias("out"))
        got = F.aggregate(steps, none, lambda a, x: F.struct((a["at"] + x["b"] + x["n"]).alias("at"), F.array_append(a["out"], F.struct((a["at"] + x["b"]).alias("s"), x["n"].alias("n"))).alias("out")))
        return F.transform(got["out"], lambda h: F.struct(h["s"].alias("s"), h["n"].alias("n"), r["label"].alias("label"), r["sure"].alias("sure"), r["pri"].alias("pri")))

    hits = F.array_sort(F.flatten(F.transform(rules_of, places)))

    def beaten(h):
        def by(o):
            inside = (o["s"] <= h["s"]) & (o["s"] + o["n"] >= h["s"] + h["n"]) & (o["n"] > h["n"])
            crossing = (o["s"] < h["s"] + h["n"]) & (h["s"] < o["s"] + o["n"]) & ~((h["s"] <= o["s"]) & (h["s"] + h["n"] >= o["s"] + o["n"]) & (h["n"] > o["n"]))
            return inside | (crossing & (o["pri"] < h["pri"]))

        return lambda hs: F.exists(hs, by)

    return F.transform(F.array(hits), lambda hs: F.filter(hs, lambda h, i: ~beaten(h)(F.slice(hs, F.greatest(i + 1 - NEAR, F.lit(1)), 2 * NEAR))))[0]


def scan(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, n_words, places of base phrases (n_base, first_word, last_word), base and all labels, score."""
    words = F.trim(F.regexp_replace(own_text("text"), "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+", " "))
    x = docs.select("doc_id", words.alias("words"))
    x = x.select("doc_id", F.when(F.col("words") == "", F.lit(0).cast("bigint")).otherwise(_spaces(F.col("words")) + 1).alias("n_words"), F.when(F.col("words").rlike(ANY), lower_ascii(F.col("words"))).alias("low"))
    n, first, last, own = [], [], [], []
    for i, (phrase, label) in enumerate(PHRASES.items()):
        x = x.withColumn(f"p{i}", F.split("low", f"(?<![^ ]){phrase}(?![^ ])", -1))
        p = F.col(f"p{i}")
        some = F.coalesce(F.size(p) > 1, F.lit(False))
        n.append(F.when(some, F.size(p) - 1).otherwise(0).cast("bigint"))
        first.append(F.when(some, _spaces(F.get(p, F.lit(0)))))
        last.append(F.when(some, F.col("n_words") - _spaces(F.element_at(p, -1)) - len(phrase.split())))
        own.append(F.when(some, F.lit(label)))
    table = F.from_json(F.lit(json.dumps(rules())), "array<struct<kw:string,re:string,label:string,sure:double,pri:int>>")
    windows = F.filter(F.array_distinct(F.regexp_extract_all("low", F.lit(WINDOW), F.lit(0))), lambda w: w.rlike(GATE))
    x = x.select("doc_id", "n_words", sum(n[1:], n[0]).alias("n_base"), F.least(*first).alias("first_word"), F.greatest(*last).alias("last_word"), F.array_sort(F.array_distinct(F.array_compact(F.array(*own)))).alias("base"), F.when(F.col("low").isNotNull(), F.flatten(F.transform(windows, lambda w: _detected(w, table)))).alias("hits"))
    more = F.coalesce(F.transform("hits", lambda h: h["label"]), F.array().cast("array<string>"))
    best = F.coalesce(F.array_max(F.transform("hits", lambda h: h["sure"])), F.lit(0.0))
    return x.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", more)), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.greatest(best, F.lit(0.9))).otherwise(best).alias("score"),
    )
