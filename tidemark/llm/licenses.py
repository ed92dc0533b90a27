"""Licence scans by sentence rules.

Texts are cut into sentences and normalised. Known sentences of licences have identifiers; the identifiers of a document,
in order, form its sequence. A licence is recognised by an ordered rule: its identifiers must appear in the sequence in
that order, and rules further up take the sentences that rules further down could share. All of it is column expressions:
the known sentences are a literal map, so no rows are moved.
"""

from __future__ import annotations

import re
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Known sentences, normalised (lower case, words of letters and digits, single spaces), by identifier; fixed values.
SENTENCES = {
    "apache2_notice": [
        "licensed under the apache license version 2 0",
        "licensed under the apache license version 2 0 the license",
        "this file is licensed under the apache license version 2 0",
        "released under the apache license 2 0",
        "licensed under the apache license 2 0",
    ],
    "apache2_compliance": ["you may not use this file except in compliance with the license"],
    "apache2_copy": [
        "you may obtain a copy of the license at http www apache org licenses license 2 0",
        "http www apache org licenses license 2 0",
        "https www apache org licenses license 2 0",
    ],
    "apache2_basis": [
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed "
        "on an as is basis without warranties or conditions of any kind either express or implied",
    ],
    "mit_notice": [
        "released under the mit license",
        "licensed under the mit license",
        "this project is licensed under the mit license",
        "distributed under the mit license",
        "mit license",
        "the mit license",
        "the mit license mit",
    ],
    "mit_grant": [
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following conditions",
    ],
    "mit_condition": [
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the software",
    ],
    "as_is": [
        "the software is provided as is without warranty of any kind express or implied including but not limited to the "
        "warranties of merchantability fitness for a particular purpose and noninfringement",
    ],
    "gpl3_notice": [
        "this work is licensed under the gnu general public license version 3",
        "licensed under the gnu general public license version 3",
        "licensed under the gnu gpl version 3",
        "released under the gnu general public license version 3",
        "licensed under the gnu general public license v3 0",
        "released under the gnu general public license v3 0",
        "licensed under the gnu gpl v3 0",
        "licensed under the gnu gpl v3",
    ],
    "gpl2_notice": [
        "this work is licensed under the gnu general public license version 2",
        "licensed under the gnu general public license version 2",
    ],
    "gpl_redistribute_2": [
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation either version 2 of the license or at your option any later "
        "version",
    ],
    "gpl_redistribute_3": [
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation either version 3 of the license or at your option any later "
        "version",
    ],
    "gpl_no_warranty": [
        "this program is distributed in the hope that it will be useful but without any warranty without even the implied "
        "warranty of merchantability or fitness for a particular purpose",
    ],
    "gpl_free": ["this program is free software"],
    "gpl_terms": [
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
        "free software foundation",
    ],
    "gpl_either_2": ["either version 2 of the license or at your option any later version"],
    "gpl_either_3": ["either version 3 of the license or at your option any later version"],
    "gpl_terms_2": [
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
        "free software foundation either version 2 of the license or at your option any later version",
    ],
    "gpl_terms_3": [
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
        "free software foundation either version 3 of the license or at your option any later version",
    ],
    "gpl_hope": ["this program is distributed in the hope that it will be useful but without any warranty"],
    "gpl_implied": ["without even the implied warranty of merchantability or fitness for a particular purpose"],
    "lgpl_free": ["this library is free software"],
    "lgpl_terms": [
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by "
        "the free software foundation",
    ],
    "agpl_terms": [
        "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by "
        "the free software foundation",
    ],
    "lgpl_terms_21": [
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by "
        "the free software foundation either version 2 1 of the license or at your option any later version",
    ],
    "lgpl_terms_3": [
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by "
        "the free software foundation either version 3 of the license or at your option any later version",
    ],
    "agpl_terms_3": [
        "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by "
        "the free software foundation either version 3 of the license or at your option any later version",
    ],
    "gpl_either_21": ["either version 2 1 of the license or at your option any later version"],
    "lgpl21_notice": [
        "licensed under the gnu lesser general public license version 2 1",
        "licensed under the gnu lgpl version 2 1",
        "licensed under the gnu lgpl v2 1",
    ],
    "lgpl3_notice": [
        "licensed under the gnu lesser general public license version 3",
        "licensed under the gnu lesser general public license v3 0",
        "licensed under the gnu lgpl version 3",
        "licensed under the gnu lgpl v3 0",
        "licensed under the gnu lgpl v3",
    ],
    "agpl3_notice": [
        "licensed under the gnu affero general public license version 3",
        "licensed under the gnu affero general public license v3 0",
        "licensed under the gnu agpl version 3",
        "licensed under the gnu agpl v3 0",
        "licensed under the gnu agpl v3",
    ],
    "isc_grant": [
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
        "permission to use copy modify and distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
    ],
    "isc_notice": ["licensed under the isc license", "released under the isc license", "isc license"],
    "bsd_notice": ["licensed under the bsd license", "use of this source code is governed by a bsd style license"],
    "bsd_grant": [
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met",
    ],
    "bsd_source": [
        "redistributions of source code must retain the above copyright notice this list of conditions and the following "
        "disclaimer",
    ],
    "bsd_binary": [
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
        "following disclaimer in the documentation and or other materials provided with the distribution",
    ],
    "bsd_endorse": [
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission",
    ],
    "bsd_disclaimer": [
        "this software is provided by the copyright holders and contributors as is and any express or implied warranties "
        "including but not limited to the implied warranties of merchantability and fitness for a particular purpose are "
        "disclaimed",
    ],
    "mpl2_notice": [
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        "licensed under the mozilla public license version 2 0",
    ],
    "cc_by_nc_4": [
        "licensed under cc by nc 4 0",
        "this work is licensed under cc by nc 4 0",
        "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    ],
    "cc_by_sa_4": [
        "licensed under cc by sa 4 0",
        "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    ],
    "cc_by_4": [
        "licensed under cc by 4 0",
        "this work is licensed under a creative commons attribution 4 0 international license",
    ],
    "cc0": ["licensed under cc0 1 0", "this work is dedicated to the public domain"],
    "all_rights": ["all rights reserved"],
}
#: Names that a line "SPDX-License-Identifier: ..." may state; fixed values.
SPDX = (
    "Apache-2.0", "MIT", "ISC", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only",
    "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "BSD-2-Clause",
    "BSD-3-Clause", "MPL-2.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "Unlicense", "Zlib",
)
SENTENCES |= {f"spdx_{n}": [re.sub("[^a-z0-9]+", " ", f"spdx license identifier {n}".lower())] for n in SPDX}
#: Where a known sentence names somebody, whoever it is: what is looked up instead; fixed values.
NAMED = (
    (r"^neither the names? of .{1,300}? nor the names of (?:its|their|any) contributors", "neither the name of the copyright holder nor the names of its contributors"),
    (r"^this software is provided by .{1,300}? as is and any express", "this software is provided by the copyright holders and contributors as is and any express"),
)
#: Ordered rules: a licence, and the identifiers that must follow each other, others in between allowed; fixed values.
RULES = (
    ("Apache-2.0", ("apache2_notice", "apache2_compliance", "apache2_copy", "apache2_basis")),
    ("Apache-2.0", ("apache2_notice",)),
    ("MIT", ("mit_grant", "mit_condition", "as_is")),
    ("MIT", ("mit_grant", "mit_condition")),
    ("MIT", ("mit_notice",)),
    ("GPL-3.0-or-later", ("gpl_redistribute_3", "gpl_no_warranty")),
    ("GPL-3.0-or-later", ("gpl_redistribute_3",)),
    ("GPL-3.0-or-later", ("gpl_free", "gpl_terms_3", "gpl_hope", "gpl_implied")),
    ("GPL-3.0-or-later", ("gpl_free", "gpl_terms_3")),
    ("GPL-3.0-or-later", ("gpl_free", "gpl_terms", "gpl_either_3", "gpl_hope", "gpl_implied")),
    ("GPL-3.0-or-later", ("gpl_free", "gpl_terms", "gpl_either_3")),
    ("GPL-2.0-or-later", ("gpl_redistribute_2", "gpl_no_warranty")),
    ("GPL-2.0-or-later", ("gpl_redistribute_2",)),
    ("GPL-2.0-or-later", ("gpl_free", "gpl_terms_2", "gpl_hope", "gpl_implied")),
    ("GPL-2.0-or-later", ("gpl_free", "gpl_terms_2")),
    ("GPL-2.0-or-later", ("gpl_free", "gpl_terms", "gpl_either_2", "gpl_hope", "gpl_implied")),
    ("GPL-2.0-or-later", ("gpl_free", "gpl_terms", "gpl_either_2")),
    ("GPL-3.0-only", ("gpl3_notice",)),
    ("GPL-2.0-only", ("gpl2_notice",)),
    ("LGPL-2.1-or-later", ("lgpl_free", "lgpl_terms", "gpl_either_21")),
    ("LGPL-2.1-or-later", ("lgpl_free", "lgpl_terms_21")),
    ("LGPL-3.0-or-later", ("lgpl_free", "lgpl_terms", "gpl_either_3")),
    ("LGPL-3.0-or-later", ("lgpl_free", "lgpl_terms_3")),
    ("AGPL-3.0-or-later", ("gpl_free", "agpl_terms", "gpl_either_3")),
    ("AGPL-3.0-or-later", ("gpl_free", "agpl_terms_3")),
    ("LGPL-2.1-only", ("lgpl21_notice",)),
    ("LGPL-3.0-only", ("lgpl3_notice",)),
    ("AGPL-3.0-only", ("agpl3_notice",)),
    ("ISC", ("isc_grant",)),
    ("ISC", ("isc_notice",)),
    ("BSD-3-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_endorse", "bsd_disclaimer")),
    ("BSD-3-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_endorse")),
    ("BSD-2-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_disclaimer")),
    ("BSD-2-Clause", ("bsd_grant", "bsd_source", "bsd_binary")),
    ("BSD", ("bsd_notice",)),
    ("MPL-2.0", ("mpl2_notice",)),
    ("CC-BY-NC-4.0", ("cc_by_nc_4",)),
    ("CC-BY-SA-4.0", ("cc_by_sa_4",)),
    ("CC-BY-4.0", ("cc_by_4",)),
    ("CC0-1.0", ("cc0",)),
    ("All-Rights-Reserved", ("all_rights",)),
    *((name, (f"spdx_{name}",)) for name in SPDX),
)
#: A stop followed by white space, but not that of "v. 2.0" or "SPDX-License-Identifier: ...".
STOP = r"(?<![^\p{L}\p{N}][vV])(?<!License-Identifier)[.!?:;]+[\x20\x09-\x0D]+"
#: Where a sentence ends: after a stop, and at a line's end.
SENTENCE_END = STOP + r"|[\n\r]+"
#: The same for texts whose sentences run over line ends: a line without letters and digits (empty, or a comment's mark)
#: ends one, a single line end does not.
WRAPPED_END = STOP + r"|\n[^\p{L}\p{N}\n]*\n+"
#: Longest known sentence, and by how much a name within may lengthen it; longer normalised sentences are not known.
LONGEST, SLOT = max(len(s) for known in SENTENCES.values() for s in known), 300
#: A document is read sentence by sentence only if it holds one of these words; each known sentence holds one.
HINT = r"(?i)licen[cs]e|permission|redistribut|warrant|copyright|rights reserved|noninfringement|public domain|cc0|free software"


def normalised(sentence: Column) -> Column:
    """Lower case, anything but letters and digits a single space."""
    return F.trim(F.regexp_replace(F.lower(sentence), r"[^\p{L}\p{N}]+", " "))


def sentence_ids(text: Column, end: str) -> Column:
    """The identifiers of a text's known sentences, in order."""
    known = F.create_map(*chain.from_iterable((F.lit(s), F.lit(k)) for k, own in SENTENCES.items() for s in own))
    plain = F.filter(F.transform(F.split(text, end), normalised), lambda s: F.length(s).between(3, LONGEST + SLOT))
    found = F.transform(plain, lambda s: F.try_element_at(known, _unnamed(s)))
    return F.filter(found, lambda k: k.isNotNull())


def _unnamed(sentence: Column) -> Column:
    """A sentence with the holder that it names replaced by the usual words."""
    for pattern, usual in NAMED:
        start = pattern.split(" .{")[0].lstrip("^").replace("names?", "name")
        sentence = F.when(sentence.startswith(start), F.regexp_replace(sentence, pattern, usual)).otherwise(sentence)
    return sentence


def _pattern(ids: tuple[str, ...]) -> tuple[str, str]:
    """A rule as an expression over a sequence, and what replaces a match: used sentences are struck out, others stay."""
    first, *rest = ids
    between = "".join(f",((?:[^,]+,)*?){i}" for i in rest)
    return f"(?<=,){first}{between}(?=,)", "-" + "".join(f",${n}-" for n in range(1, len(rest) + 1))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, licenses, sentence_ids, n_sentences``.

    ``sentence_ids`` is the sequence of known sentences in reading order, ``licenses`` the licences whose rules it
    satisfies, in the order of the rules, each once. A rule uses up the sentences it matched, so the notice within a
    full licence text is not counted again. Line ends end sentences; where reading across single line ends knows more
    sentences, that reading counts. Null and empty texts have none. Rows are judged on their own, repeated ones alike;
    an empty table gives no rows. Only id and text are read, so further columns may have any names.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    hinted = F.when(text.rlike(HINT), text).otherwise(F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), hinted.alias("_text"))
    by_line, wrapped = sentence_ids(F.col("_text"), SENTENCE_END), sentence_ids(F.col("_text"), WRAPPED_END)
    none = F.array().cast("array<string>")
    both = F.struct(by_line.alias("a"), wrapped.alias("b"))
    both = F.when(F.col("_text") == "", F.struct(none.alias("a"), none.alias("b"))).otherwise(both)
    read = rows.select("doc_id", both.alias("_read"))
    ids = F.when(F.size("_read.b") > F.size("_read.a"), F.col("_read.b")).otherwise(F.col("_read.a"))
    found = read.select("doc_id", ids.alias("sentence_ids"))
    left = F.concat(F.lit(","), F.array_join("sentence_ids", ","), F.lit(","))
    names = []
    step = found.withColumn("_left", left)
    for n, (name, rule) in enumerate(RULES):
        expression, struck = _pattern(rule)
        step = step.withColumn(f"_rule{n}", F.when(F.col("_left").rlike(expression), F.lit(name)))
        step = step.withColumn("_left", F.regexp_replace("_left", expression, struck))
        names.append(F.col(f"_rule{n}"))
    licenses = F.array_distinct(F.filter(F.array(*names), lambda x: x.isNotNull()))
    return step.select(
        "doc_id", licenses.alias("licenses"), "sentence_ids", F.size("sentence_ids").cast("long").alias("n_sentences")
    )
