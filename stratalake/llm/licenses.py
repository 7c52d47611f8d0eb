"""Licence scan by sentence rules; DataFrame functions only.

A text is cut into sentences: after . ! ? before white space, and at line ends unless the next
line goes on with a lower-case letter, a quote or a bracket (a wrapped line). Each is
normalised (lower case, runs of anything but letters and digits become one space; comment marks
go with them) and mapped to the identifier of a known licence sentence. Lines that follow each
other without . ! ? between them, blank ones or not, are also tried joined, the longest sentence
first: a sentence may be wrapped anywhere, in comments, too. Inside any other sentence the words
"licensed (released, distributed, ...) under" and a licence's name are known by themselves. A text's
identifiers, in the order in which they occur, are matched against the ordered rules: the first rule
whose identifiers occur one after the other takes its place in the result, and later rules see what
is left.

All of it is an expression on one row: nothing is shuffled, grouped or collected, however many
sentences a text has or however often one is repeated. Every step is linear in the text: blanks and
line ends are collapsed before anything looks across them.

Covered: headers, titles or grants of MIT, Apache-2.0, GPL-2.0 and 3.0, LGPL-2.1 and 3.0, AGPL-3.0,
BSD-2-Clause and 3-Clause, MPL-2.0, ISC, Unlicense, EPL-2.0, BSL-1.0, Zlib, CC-BY, CC-BY-SA and
CC-BY-NC 4.0, CC0-1.0; SPDX lines with one of `SPDX`; "all rights reserved". SPDX expressions (OR, AND,
WITH), other licences and the full texts beyond these sentences are not.

Null and empty texts and texts without a known sentence have no licence (empty lists, `none`).
Known sentences that no rule takes are reported as `unmatched`. Repeated rows get equal results.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Licence sentences as they are written, by identifier.
SENTENCES = {
    "mitTitle": "The MIT License",
    "mitTitleOsi": "MIT License",
    "mitRelease": "Released under the MIT License",
    "mitLicensed": "Licensed under the MIT License",
    "mitGrant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights "
    "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
    "whom the Software is furnished to do so, subject to the following conditions:",
    "mitNotice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "apacheVer2": "Licensed under the Apache License, Version 2.0",
    "apacheLongVer2": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License",
    "apacheCopy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apacheAsIs": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
    "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "gplVer3": "This work is licensed under the GNU General Public License, version 3",
    "gplFree": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
    "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gplFree2": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
    "as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    "gplHope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty "
    "of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "bsdRedistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:",
    "bsdSource": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsdBinary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution",
    "bsdEndorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission",
    "mplVer2": "This Source Code Form is subject to the terms of the Mozilla Public License, v.",
    "ccBy4": "Licensed under CC BY 4.0",
    "ccBySa4": "Licensed under CC BY-SA 4.0",
    "ccByNc4": "Licensed under CC BY-NC 4.0",
    "ccZero": "This work is dedicated to the public domain under CC0 1.0",
    "allRights": "All rights reserved",
    "mitAsIs": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "apacheTitle": "Apache License Version 2.0, January 2004",
    "gplTitle3": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "gplTitle2": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "lgplTitle3": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "agplTitle3": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "lgplFree21": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
    "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version",
    "lgplHope": "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty "
    "of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "lgplFree3": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
    "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "agplFree3": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
    "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "iscGrant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies",
    "iscAsIs": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
    "WARRANTIES OF MERCHANTABILITY AND FITNESS",
    "unlicenseFree": "This is free and unencumbered software released into the public domain",
    "unlicenseAnyone": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form "
    "or as a compiled binary, for any purpose, commercial or non-commercial, and by any means",
    "eplVer2": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is "
    "available at https://www.eclipse.org/legal/epl-2.0/",
    "boostVer1": "Distributed under the Boost Software License, Version 1.0",
    "zlibAsIs": "This software is provided 'as-is', without any express or implied warranty",
    "zlibGrant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it "
    "and redistribute it freely, subject to the following restrictions:",
    "bsdAsIs": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, "
    "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED",
    "ccZeroWaiver": "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or "
    "neighboring rights to this work",
}

# Names after "licensed under".
NAMES = {
    "MIT": ("MIT License", "MIT Licence", "MIT"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache License v2.0", "Apache 2.0 License", "Apache-2.0"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU General Public License v3", "GNU General Public License v3.0", "GPLv3", "GPL-3.0"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU General Public License v2", "GNU General Public License v2.0", "GPLv2", "GPL-2.0"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "LGPLv3", "LGPL-3.0"),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "LGPLv2.1", "LGPL-2.1"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "AGPLv3", "AGPL-3.0"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "BSD-3-Clause"),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "BSD-2-Clause"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0"),
    "ISC": ("ISC License",),
    "Unlicense": ("Unlicense",),
    "EPL-2.0": ("Eclipse Public License 2.0", "Eclipse Public License, version 2.0", "EPL-2.0"),
    "BSL-1.0": ("Boost Software License, Version 1.0", "Boost Software License 1.0", "BSL-1.0"),
    "Zlib": ("zlib License",),
    "CC-BY-4.0": ("Creative Commons Attribution 4.0 International License", "CC BY 4.0"),
    "CC-BY-SA-4.0": ("Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA 4.0"),
    "CC-BY-NC-4.0": ("Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-NC 4.0"),
    "CC0-1.0": ("CC0 1.0",),
}
UNDER = ("licensed", "licenced", "released", "distributed", "available", "published", "provided", "covered")

# Identifiers that a line "SPDX-License-Identifier:" may name.
SPDX = (
    "MIT", "Apache-2.0", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1", "LGPL-2.1-only",
    "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "BSD-2-Clause",
    "BSD-3-Clause", "MPL-2.0", "ISC", "Unlicense", "EPL-2.0", "BSL-1.0", "Zlib", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC0-1.0",
)
SENTENCES |= {f"spdx:{x}": f"SPDX-License-Identifier: {x}" for x in SPDX}

# Ordered rules, longer ones first.
RULES = (
    ("BSD-3-Clause", ("bsdRedistribution", "bsdSource", "bsdBinary", "bsdEndorse", "bsdAsIs")),
    ("BSD-3-Clause", ("bsdRedistribution", "bsdSource", "bsdBinary", "bsdEndorse")),
    ("BSD-2-Clause", ("bsdRedistribution", "bsdSource", "bsdBinary", "bsdAsIs")),
    ("BSD-2-Clause", ("bsdRedistribution", "bsdSource", "bsdBinary")),
    ("MIT", ("mitTitle", "mitGrant", "mitNotice", "mitAsIs")),
    ("MIT", ("mitTitleOsi", "mitGrant", "mitNotice", "mitAsIs")),
    ("MIT", ("mitGrant", "mitNotice", "mitAsIs")),
    ("MIT", ("mitTitle", "mitGrant", "mitNotice")),
    ("MIT", ("mitTitleOsi", "mitGrant", "mitNotice")),
    ("MIT", ("mitGrant", "mitNotice")),
    ("Apache-2.0", ("apacheLongVer2", "apacheCopy", "apacheAsIs")),
    ("GPL-3.0-or-later", ("gplFree", "gplHope")),
    ("GPL-2.0-or-later", ("gplFree2", "gplHope")),
    ("LGPL-2.1-or-later", ("lgplFree21", "lgplHope")),
    ("LGPL-3.0-or-later", ("lgplFree3", "gplHope")),
    ("AGPL-3.0-or-later", ("agplFree3", "gplHope")),
    ("ISC", ("iscGrant", "iscAsIs")),
    ("Unlicense", ("unlicenseFree", "unlicenseAnyone")),
    ("Zlib", ("zlibAsIs", "zlibGrant")),
    ("MIT", ("mitRelease",)),
    ("MIT", ("mitLicensed",)),
    ("MIT", ("mitTitleOsi",)),
    ("Apache-2.0", ("apacheLongVer2",)),
    ("Apache-2.0", ("apacheVer2",)),
    ("GPL-3.0", ("gplVer3",)),
    ("GPL-3.0-or-later", ("gplFree",)),
    ("GPL-2.0-or-later", ("gplFree2",)),
    ("MPL-2.0", ("mplVer2",)),
    ("CC-BY-SA-4.0", ("ccBySa4",)),
    ("CC-BY-NC-4.0", ("ccByNc4",)),
    ("CC-BY-4.0", ("ccBy4",)),
    ("CC0-1.0", ("ccZero",)),
    ("CC0-1.0", ("ccZeroWaiver",)),
    ("Apache-2.0", ("apacheTitle",)),
    ("GPL-3.0", ("gplTitle3",)),
    ("GPL-2.0", ("gplTitle2",)),
    ("LGPL-3.0", ("lgplTitle3",)),
    ("AGPL-3.0", ("agplTitle3",)),
    ("LGPL-2.1-or-later", ("lgplFree21",)),
    ("LGPL-3.0-or-later", ("lgplFree3",)),
    ("AGPL-3.0-or-later", ("agplFree3",)),
    ("ISC", ("iscGrant",)),
    ("Unlicense", ("unlicenseFree",)),
    ("EPL-2.0", ("eplVer2",)),
    ("BSL-1.0", ("boostVer1",)),
    ("Zlib", ("zlibGrant",)),
    ("all-rights-reserved", ("allRights",)),
    *((x, (f"spdx:{x}",)) for x in SPDX),
    *((x, (f"under:{x}",)) for x in NAMES),
)

WRAPPED, STOP = r"\n[\x20\x09]*([a-z(\"])", r"(?<=[.!?])[\x20\x09-\x0D]+"
# Comment marks that are words, or that would end a sentence.
MARK = r"(?im)^[\x20\x09]*(?:!+|@?rem|dnl|@?c)[\x20\x09]+"
# Lines end with \n, sentences with \f; neither has blanks around it or follows another.
NOISE, LINES, STOPS = r"[^\p{L}\p{N}\n\f]+", r"\x20?\n[\x20\n]*", r"[\x20\n]?\f[\x20\n\f]*"
# What ends a word stands twice, so that neighbouring matches have one each.
DOUBLED = ((" ", "  "), ("\n", "\n\n"), ("\f", "\n\f\n"))
BETWEEN = r"(?:\x20\x20|\n\n)"
LEAD = rf"(?:{'|'.join(UNDER)}) under (?:the )?(?:terms of (?:the )?)?"


def normal(sentence: str) -> str:
    return re.sub(r"[\W_]+", " ", sentence.lower()).strip()


def known_of(sentences: dict[str, str]) -> dict[str, str]:
    """Normalised sentences to identifiers."""
    return {normal(s): name for name, s in sentences.items()}


def names_of() -> dict[str, str]:
    """Normalised licence names to the identifiers of what stands under them."""
    return {normal(n): f"under:{licence}" for licence, names in NAMES.items() for n in names}


def pattern_of(known: dict[str, str]) -> str:
    """A whole known sentence between two ends, else the words for "licensed under" a name; the
    longest first. Any blank may be a line end. Without look-around, for any engine."""
    either = lambda found: "|".join(sorted(found, key=lambda x: (-len(x), x)))
    return rf"\n(?:{either(known)})\n|[\x20\n]{LEAD}(?:{either(names_of())})[\x20\n]".replace(" ", BETWEEN)


def sentence_ids(text: Column, sentences: dict[str, str] = SENTENCES) -> Column:
    """Identifiers of the known sentences in order of occurrence."""
    known = known_of(sentences)
    table = lambda found: F.create_map(*[F.lit(x) for pair in found.items() for x in pair])
    whole, named = table(known), table(names_of())
    lines = F.regexp_replace(F.coalesce(text, F.lit("")), WRAPPED, " $1")
    lines = F.regexp_replace(F.translate(lines, "\f", " "), MARK, "")
    plain = F.regexp_replace(F.lower(F.regexp_replace(lines, STOP, "\f")), NOISE, " ")
    plain = F.trim(F.regexp_replace(F.regexp_replace(plain, LINES, "\n"), STOPS, "\f"))
    for one, two in DOUBLED:
        plain = F.replace(plain, F.lit(one), F.lit(two))
    found = F.regexp_extract_all(F.concat(F.lit("\n"), plain, F.lit("\n")), F.lit(pattern_of(known)), F.lit(0))
    sentence = lambda s: F.trim(F.regexp_replace(s, r"[\x20\n]+", " "))
    name = lambda s: F.regexp_replace(sentence(s), f"^{LEAD}", "")
    return F.transform(found, lambda s: F.coalesce(F.try_element_at(whole, sentence(s)), F.try_element_at(named, name(s))))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sentences: dict[str, str] = SENTENCES, rules=RULES) -> DataFrame:
    """(doc_id, sentence_ids, licences, licence, unmatched), one row per row of `docs`.

    `licences` are the matches in order of their place, a licence matched several times once.
    """
    mark = lambda ids: "|" + "||".join(ids) + "|"
    ids = docs.select(F.col(doc_id).alias("doc_id"), sentence_ids(F.col(text), sentences).alias("ids"))
    # |a||b||c|: a rule is a run of marks; what it takes is replaced by <licence>.
    line = F.concat_ws("", F.transform("ids", lambda x: F.concat(F.lit("|"), x, F.lit("|"))))
    for licence, needed in rules:
        line = F.replace(line, F.lit(mark(needed)), F.lit(f"<{licence}>"))
    found = ids.select("doc_id", "ids", line.alias("line"))
    licences = F.array_distinct(F.regexp_extract_all("line", F.lit("<([^>]*)>"), F.lit(1)))
    unmatched = F.regexp_extract_all("line", F.lit(r"\|([^|]*)\|"), F.lit(1))
    out = found.select(
        "doc_id", F.concat_ws(",", "ids").alias("sentence_ids"), licences.alias("licences"), F.concat_ws(",", unmatched).alias("unmatched")
    )
    return out.select(
        "doc_id",
        "sentence_ids",
        F.concat_ws(",", "licences").alias("licences"),
        F.when(F.size("licences") == 0, "none").when(F.size("licences") == 1, F.col("licences")[0]).otherwise("several").alias("licence"),
        "unmatched",
    )
