"""License scans by ordered signature rules.

Several hundred signatures - regular expressions over normalised words - stand in order of priority: declarations
("licensed under ..."), sentences of license texts, names with a version, bare names.  Every signature has a keyword:
one intersection of the text's words with all keywords tells which signatures may fire, and of these only those run
whose needle - a fixed stretch of words - the text holds.  Most texts have no keyword and are done.

Signatures run on a copy of the text in which every word carries its number, so a match tells its own place and work is
near linear in the number of matches.  Overlaps are settled in one sweep in text order: of two detections that share a word,
the one of the higher class stays; in one class, one that lies inside another goes, and of two that only overlap the
one earlier in the list stays.  A detection that lost against one that loses later does not come back.  What stays
gives the labels and the score.

All of it is expressions inside one row: no shuffle, no Python.  Beside the signatures, plain phrases are counted
wherever their words stand in a row; their labels always stay.

Defined results: a null text is empty; a text without words has no detection and score 0; rows that repeat are judged
alike; an empty table gives an empty result; input columns with the names of added ones are replaced.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.text import ASCII_UPPER, bind

#: The base phrases and their labels.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))
ADDED = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections")
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Licenses by label: keyword, the ways to write the name in normalised words, versions that may follow.
FAMILIES: tuple[tuple[str, str, tuple[str, ...], tuple[str, ...]], ...] = (
    ("gpl", "gnu", ("gnu general public license", "gnu gpl"), ("1", "2", "3")),
    ("gpl", "gpl", ("gpl",), ("1", "2", "3")),
    ("gpl", "gplv2", ("gplv2",), ()),
    ("gpl", "gplv3", ("gplv3",), ()),
    ("lgpl", "gnu", ("gnu lesser general public license", "gnu library general public license"), ("2", "2 1", "3")),
    ("lgpl", "lgpl", ("lgpl", "gnu lgpl"), ("2", "2 1", "3")),
    ("agpl", "gnu", ("gnu affero general public license",), ("3",)),
    ("agpl", "affero", ("affero general public license",), ("1", "3")),
    ("agpl", "agpl", ("agpl", "gnu agpl"), ("3",)),
    ("gfdl", "gnu", ("gnu free documentation license",), ("1 1", "1 2", "1 3")),
    ("apache", "apache", ("apache license", "apache software license", "apache public license"), ("1 0", "1 1", "2 0")),
    ("mit", "mit", ("mit license", "mit x11 license", "mit expat license"), ()),
    ("mit", "expat", ("expat license",), ()),
    ("bsd", "bsd", ("bsd license", "bsd style license", "new bsd license", "modified bsd license", "simplified bsd license"), ("2 clause", "3 clause", "4 clause")),
    ("isc", "isc", ("isc license",), ()),
    ("mpl", "mozilla", ("mozilla public license",), ("1 0", "1 1", "2 0")),
    ("mpl", "mpl", ("mpl",), ("1 1", "2 0")),
    ("epl", "eclipse", ("eclipse public license", "eclipse distribution license"), ("1 0", "2 0")),
    ("cddl", "cddl", ("cddl",), ("1 0", "1 1")),
    ("cddl", "distribution", ("common development and distribution license",), ("1 0", "1 1")),
    ("cpl", "common", ("common public license",), ("1 0",)),
    ("eupl", "eupl", ("eupl",), ("1 1", "1 2")),
    ("eupl", "european", ("european union public license",), ("1 1", "1 2")),
    ("artistic", "artistic", ("artistic license", "clarified artistic license"), ("1 0", "2 0")),
    ("zlib", "zlib", ("zlib license", "zlib libpng license"), ()),
    ("boost", "boost", ("boost software license",), ("1 0",)),
    ("unlicense", "unlicense", ("unlicense",), ()),
    ("wtfpl", "wtfpl", ("wtfpl",), ("2",)),
    ("ofl", "font", ("sil open font license", "open font license"), ("1 0", "1 1")),
    ("odbl", "database", ("open database license", "open data commons open database license"), ("1 0",)),
    ("odc-by", "odc", ("odc by",), ("1 0",)),
    ("pddl", "dedication", ("public domain dedication and license",), ("1 0",)),
    ("python", "python", ("python software foundation license", "psf license agreement"), ("2",)),
    ("php", "php", ("php license",), ("3 0", "3 01")),
    ("ruby", "ruby", ("ruby license",), ()),
    ("perl", "perl", ("same terms as perl itself", "same terms as perl"), ()),
    ("openssl", "openssl", ("openssl license",), ()),
    ("postgresql", "postgresql", ("postgresql license",), ()),
    ("ms-pl", "microsoft", ("microsoft public license", "microsoft reciprocal license"), ()),
    ("osl", "open", ("open software license",), ("1 0", "2 0", "2 1", "3 0")),
    ("afl", "academic", ("academic free license",), ("1 2", "2 0", "2 1", "3 0")),
    ("qpl", "q", ("q public license",), ("1 0",)),
    ("bsl", "business", ("business source license",), ("1 0", "1 1")),
    ("sspl", "server", ("server side public license",), ("1",)),
    ("elastic", "elastic", ("elastic license",), ("2 0",)),
    ("vim", "vim", ("vim license",), ()),
    ("tex", "lppl", ("lppl",), ("1 0", "1 1", "1 2", "1 3")),
    ("tex", "latex", ("latex project public license",), ("1 0", "1 1", "1 2", "1 3")),
    ("cecill", "cecill", ("cecill", "cecill b", "cecill c"), ("1 0", "2 0", "2 1")),
    ("upl", "permissive", ("universal permissive license",), ("1 0",)),
    ("openrail", "openrail", ("openrail", "creativeml openrail m", "bigscience openrail m"), ("1 0",)),
    ("cc-by-nc-nd", "nd", ("cc by nc nd", "creative commons by nc nd"), ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-sa", "sa", ("cc by nc sa", "creative commons by nc sa"), ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc", "nc", ("cc by nc", "creative commons by nc"), ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nd", "nd", ("cc by nd", "creative commons by nd"), ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-sa", "sa", ("cc by sa", "creative commons by sa"), ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by", "cc", ("cc by",), ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by", "creative", ("creative commons attribution", "creative commons attribution license"), ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-sa", "sharealike", ("creative commons attribution sharealike", "attribution sharealike"), ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-sa", "alike", ("creative commons attribution share alike", "attribution share alike"), ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc", "noncommercial", ("creative commons attribution noncommercial", "attribution noncommercial"), ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc", "commercial", ("creative commons attribution non commercial", "attribution non commercial"), ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-sa", "sharealike", ("creative commons attribution noncommercial sharealike", "attribution noncommercial sharealike"), ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-sa", "alike", ("creative commons attribution noncommercial share alike", "creative commons attribution non commercial share alike", "attribution noncommercial share alike", "attribution non commercial share alike"), ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nd", "noderivatives", ("creative commons attribution noderivatives", "attribution noderivatives"), ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nd", "noderivs", ("creative commons attribution noderivs", "attribution noderivs"), ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nd", "derivatives", ("creative commons attribution no derivatives", "attribution no derivatives"), ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-nd", "noderivatives", ("creative commons attribution noncommercial noderivatives", "attribution noncommercial noderivatives"), ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-nd", "noderivs", ("creative commons attribution noncommercial noderivs", "attribution noncommercial noderivs"), ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-nd", "derivatives", ("creative commons attribution non commercial no derivatives", "creative commons attribution noncommercial no derivatives", "attribution non commercial no derivatives"), ("2 0", "2 5", "3 0", "4 0")),
    ("cc0", "cc0", ("cc0",), ("1 0",)),
    ("public-domain", "public", ("released into the public domain", "dedicated to the public domain", "placed in the public domain"), ()),
)

#: Sentences of license texts and notices, by label, as normalised words.
SENTENCES: tuple[tuple[str, str], ...] = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "in no event shall the authors or copyright holders be liable for any claim damages or other liability"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose"),
    ("isc", "the software is provided as is and the author disclaims all warranties with regard to this software"),
    ("bsd", "redistribution and use in source and binary forms with or without modification"),
    ("bsd", "redistributions of source code must retain the above copyright notice"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"),
    ("bsd", "all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("bsd", "this software is provided by the copyright holders and contributors as is"),
    ("apache", "you may not use this file except in compliance with the license"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache", "see the license for the specific language governing permissions and limitations under the license"),
    ("apache", "licensed to the apache software foundation asf under one or more contributor license agreements"),
    ("apache", "you must cause any modified files to carry prominent notices stating that you changed the files"),
    ("apache", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "you should have received a copy of the gnu general public license along with this program"),
    ("gpl", "see the gnu general public license for more details"),
    ("gpl", "either version (?:1|2|3) of the license or at your option any later version"),
    ("gpl", "this program comes with absolutely no warranty"),
    ("gpl", "this is free software and you are welcome to redistribute it under certain conditions"),
    ("gpl", "the licenses for most software are designed to take away your freedom to share and change it"),
    ("gpl", "the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("gpl", "as a special exception the (?:free software foundation gives|copyright holders give) unlimited permission"),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu library general public license"),
    ("lgpl", "you should have received a copy of the gnu lesser general public license along with this library"),
    ("lgpl", "see the gnu lesser general public license for more details"),
    ("lgpl", "this license the lesser general public license applies to some specially designated software packages"),
    ("agpl", "you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("agpl", "you should have received a copy of the gnu affero general public license along with this program"),
    ("agpl", "an opportunity to receive the corresponding source of your version by providing access to the corresponding source from a network server"),
    ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("gfdl", "with no invariant sections no front cover texts and no back cover texts"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("mpl", "if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl", "the contents of this file are subject to the mozilla public license"),
    ("mpl", "this source code form is incompatible with secondary licenses"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("epl", "all rights reserved this program and the accompanying materials are made available under the terms of the eclipse distribution license"),
    ("cddl", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("cddl", "you can obtain a copy of the license at usr src opensolaris license"),
    ("cpl", "the accompanying program is provided under the terms of this common public license"),
    ("eupl", "licensed under the eupl version 1 (?:1|2) or as soon they will be approved by the european commission"),
    ("artistic", "the intent of this document is to state the conditions under which a package may be copied"),
    ("artistic", "you may make and give away verbatim copies of the source form of the standard version of this package without restriction"),
    ("perl", "this library is free software you can redistribute it and or modify it under the same terms as perl itself"),
    ("zlib", "altered source versions must be plainly marked as such"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("zlib", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("zlib", "this notice may not be removed or altered from any source distribution"),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("boost", "distributed under the boost software license version 1 0"),
    ("unlicense", "free and unencumbered software released into the public domain"),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software"),
    ("unlicense", "the author or authors of this software dedicate any and all copyright interest in the software to the public domain"),
    ("wtfpl", "do what the fuck you want to public license"),
    ("wtfpl", "you just do what the fuck you want to"),
    ("beer-ware", "as long as you retain this notice you can do whatever you want with this stuff"),
    ("beer-ware", "if we meet some day and you think this stuff is worth it you can buy me a beer in return"),
    ("json", "the software shall be used for good not evil"),
    ("ofl", "this font software is licensed under the sil open font license"),
    ("ofl", "the font software may be sold as part of a larger software package but no copy of one or more of the font software"),
    ("ofl", "no modified version of the font software may use the reserved font name"),
    ("odbl", "this database is made available under the open database license"),
    ("odbl", "any rights in individual contents of the database are licensed under the database contents license"),
    ("odc-by", "this database is made available under the open data commons attribution license"),
    ("pddl", "this database is made available under the public domain dedication and license"),
    ("python", "psf is making python available to licensee on an as is basis"),
    ("python", "python software foundation all rights reserved"),
    ("php", "this product includes php software freely available from"),
    ("php", "this source file is subject to version 3 (?:0|01) of the php license"),
    ("ruby", "you can redistribute it and or modify it under either the terms of the 2 clause bsdl"),
    ("openssl", "this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("openssl", "this product includes cryptographic software written by eric young"),
    ("postgresql", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("ms-pl", "if you use the software you accept this license if you do not accept the license do not use the software"),
    ("osl", "licensed under the open software license version 3 0"),
    ("afl", "licensed under the academic free license version 3 0"),
    ("bsl", "the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work"),
    ("bsl", "on the change date or the fourth anniversary of the first publicly available distribution"),
    ("sspl", "making the functionality of the program or modified version available to third parties as a service"),
    ("elastic", "you may not provide the software to third parties as a hosted or managed service"),
    ("commons-clause", "the license does not grant to you and you may not sell the software"),
    ("vim", "you may distribute unmodified copies of vim without restriction"),
    ("tex", "this work may be distributed and or modified under the conditions of the latex project public license"),
    ("tex", "this work has the lppl maintenance status"),
    ("cecill", "this software is governed by the cecill license under french law and abiding by the rules of distribution of free software"),
    ("cecill", "ce logiciel est régi par la licence cecill soumise au droit français"),
    ("upl", "subject to the condition set forth below permission is hereby granted to any person obtaining a copy of this software associated documentation and or data"),
    ("openrail", "use based restrictions as referenced in paragraph 5 must be included as an enforceable provision"),
    ("openrail", "you agree not to use the model or derivatives of the model"),
    ("llama", "built with (?:meta )?llama"),
    ("llama", "llama (?:2|3|3 1|3 2|3 3) (?:is licensed under|community license)"),
    ("gemma", "gemma is provided under and subject to the gemma terms of use"),
    ("cc-by", "this work is licensed under a creative commons attribution (?:[0-9] [0-9] )?(?:international |unported |generic )?license"),
    ("cc-by", "you must give appropriate credit provide a link to the license and indicate if changes were made"),
    ("cc-by", "this article is distributed under the terms of the creative commons attribution"),
    ("cc-by", "this is an open access article distributed under the terms of the creative commons attribution license"),
    ("cc-by", "content is available under creative commons attribution"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution (?:share alike|sharealike)"),
    ("cc-by-sa", "text is available under the creative commons attribution (?:share alike|sharealike) license"),
    ("cc-by-sa", "if you remix transform or build upon the material you must distribute your contributions under the same license as the original"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution (?:non commercial|noncommercial)"),
    ("cc-by-nc", "you may not use the material for commercial purposes"),
    ("cc-by-nc", "for (?:non commercial|noncommercial) use only"),
    ("cc-by-nc-nd", "this work is licensed under a creative commons attribution (?:non commercial|noncommercial) (?:no derivatives|noderivatives|noderivs)"),
    ("cc-by-nc-sa", "this work is licensed under a creative commons attribution (?:non commercial|noncommercial) (?:share alike|sharealike)"),
    ("cc-by-nd", "if you remix transform or build upon the material you may not distribute the modified material"),
    ("cc0", "to the extent possible under law (?:the author|the person who associated cc0 with this work) has waived all copyright and related or neighboring rights"),
    ("cc0", "no rights reserved"),
    ("public-domain", "this (?:work|file|image|text|software|code) is in the public domain"),
    ("public-domain", "no copyright is claimed"),
    ("public-domain", "this work is a work of the united states government"),
    ("gutenberg", "this ebook is for the use of anyone anywhere at no cost and with almost no restrictions whatsoever"),
    ("gutenberg", "under the terms of the project gutenberg license included with this ebook"),
    ("all-rights-reserved", "all rights reserved"),
    ("all-rights-reserved", "tous droits réservés"),
    ("all-rights-reserved", "alle rechte vorbehalten"),
    ("all-rights-reserved", "todos los derechos reservados"),
    ("all-rights-reserved", "no part of this (?:publication|book|work|site|website) may be reproduced"),
    ("all-rights-reserved", "may not be reproduced distributed or transmitted in any form or by any means"),
    ("all-rights-reserved", "unauthorized (?:copying|reproduction|duplication|use) of this (?:file|work|material|content|software) (?:via any medium )?is strictly prohibited"),
    ("all-rights-reserved", "without the (?:prior|express|express prior) written (?:permission|consent) of the (?:publisher|author|copyright (?:holder|owner))"),
    ("all-rights-reserved", "reproduction in whole or in part without (?:written )?permission is (?:strictly )?prohibited"),
    ("proprietary", "proprietary and confidential"),
    ("proprietary", "confidential and proprietary"),
    ("proprietary", "redistribution (?:is )?(?:strictly )?(?:prohibited|forbidden)"),
    ("proprietary", "this software is the (?:confidential and )?proprietary (?:information|property) of"),
    ("proprietary", "you shall not disclose such confidential information"),
    ("proprietary", "contains trade secrets and proprietary information"),
    ("proprietary", "by installing copying or otherwise using the software you agree to be bound by the terms of this (?:eula|agreement)"),
    ("proprietary", "end user license agreement"),
    ("proprietary", "you may not reverse engineer decompile or disassemble"),
    ("proprietary", "for internal use only"),
    ("proprietary", "the software is licensed not sold"),
    ("copyright", "copyright (?:c )?(?:by )?(?:19|20)[0-9][0-9]"),
    ("copyright", "c (?:19|20)[0-9][0-9] all rights reserved"),
    ("warranty", "without warranty of any kind"),
    ("warranty", "without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("warranty", "the implied warranties of merchantability and fitness for a particular purpose are disclaimed"),
    ("spdx", "spdx license identifier"),
    ("spdx", "spdx (?:file)?copyrighttext"),
    ("copyleft", "copyleft"),
    ("dual", "dual licensed under"),
    ("dual", "licensed under either of"),
    ("dual", "at your option (?:under|either|any)"),
)

#: Ways in which a text declares a license, before its name, with the weight of such a detection.
DECLARATIONS: tuple[tuple[str, float], ...] = (
    ("(?:is |are |was |work is )?(?:dual )?licen[sc]ed under(?: the)?(?: terms of(?: the)?)?", 0.98),
    ("(?:is |are )?(?:released|distributed|published|available|provided) under(?: the)?(?: terms of(?: the)?)?", 0.95),
    ("spdx license identifier", 0.99),
    ("(?:subject to|governed by|covered by|according to)(?: the)?(?: terms of(?: the)?)?", 0.9),
)


#: Short names that only mean a license where the text declares one.
DECLARED_AS = {"apache": ("apache",), "mit": ("mit", "x11"), "bsd": ("bsd",), "isc": ("isc",), "zlib": ("zlib",), "boost": ("bsl",)}
#: Classes of signatures in order of priority.
DECLARED, SENTENCE, VERSIONED, NAMED = range(4)


@dataclass(frozen=True)
class Signature:
    """A rule over normalised words; ``pattern`` begins with a space and ends before one.

    Every match holds the needle and, as a whole word, the keyword.
    """

    label: str
    keyword: str
    needle: str
    pattern: str
    weight: float
    tier: int


def _by_keyword(keyword: str, names: tuple[str, ...]) -> list[tuple[str, tuple[str, ...]]]:
    """The names that hold the keyword under it, and each other name under its longest word."""
    with_it = tuple(n for n in names if f" {keyword} " in f" {n} ")
    return [(keyword, with_it)] * bool(with_it) + [(max(n.split(), key=len), (n,)) for n in names if n not in with_it]


def _sentence(label: str, pattern: str) -> Signature:
    """Its needle is the longest stretch outside groups and classes of characters, its keyword the longest word there."""
    fixed = f" {pattern} "
    while (bare := re.sub(r"\([^()]*\)\??|\[[^]]*\]", "|", fixed)) != fixed:
        fixed = bare
    whole = re.compile("(?<= )[^ ]+(?= )")
    needle = max((part for part in fixed.split("|") if whole.search(part)), key=len)
    return Signature(label, max(whole.findall(needle), key=len), needle, f" {pattern}(?= )", 0.8, SENTENCE)


def signatures() -> list[Signature]:
    """All rules in order of priority: declarations, sentences, versioned names, then bare names."""
    out: list[Signature] = []
    declared = {label: list(short) for label, short in DECLARED_AS.items()}  # the short names go with the first family of their label
    lead = "(?:" + "|".join(said for said, _ in DECLARATIONS) + ")"
    for label, keyword, names, versions in FAMILIES:
        tail = "" if not versions else "(?:(?: version)?(?: v)? (?:" + "|".join(versions) + "))?"
        for word, spelled in _by_keyword(keyword, (*names, *declared.pop(label, ()))):
            out.append(Signature(label, word, f" {word} ", f" {lead} (?:{'|'.join(spelled)}){tail}(?= )", 0.9, DECLARED))
    out += [_sentence(label, pattern) for label, pattern in SENTENCES]
    families = [(label, word, spelled, versions) for label, keyword, names, versions in FAMILIES for word, spelled in _by_keyword(keyword, names)]
    for label, word, spelled, versions in families:
        if versions:
            out.append(Signature(label, word, f" {word} ", f" (?:{'|'.join(spelled)})(?: version)?(?: v)? (?:{'|'.join(versions)})(?= )", 0.7, VERSIONED))
    out += [Signature(label, word, f" {word} ", f" (?:{'|'.join(spelled)})(?= )", 0.5, NAMED) for label, word, spelled, _ in families]
    return out


def keywords(rules: list[Signature]) -> list[str]:
    """Words of which every text with a phrase or a signature has one."""
    return sorted({r.keyword for r in rules} | {p.split()[0] for p, _ in PHRASES})


def numbered(pattern: str) -> str:
    """The pattern over words that carry their numbers."""
    return pattern.removesuffix("(?= )").replace(" ", " [0-9]+:") + "(?= )"


def normalised(text: Column) -> Column:
    """Words in lower case with one space between and around them; one space without words."""
    # Texts of ASCII alone are lower-cased bytewise, which is cheaper and the same.
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, ASCII_UPPER, ASCII_UPPER.lower()))
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(low, _BREAK, " ")), F.lit(" "))


def spaces(text: Column) -> Column:
    return (F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def base_places(flat: Column) -> dict[str, Column]:
    """Count, first and last place of all phrases, and their labels."""
    counts = [F.when(flat.contains(f" {p} "), F.size(F.split(flat, f" {p}(?= )", -1)) - 1).otherwise(0) for p, _ in PHRASES]
    firsts, lasts = [], []
    for p, _ in PHRASES:
        there = flat.contains(f" {p} ")
        firsts.append(F.when(there, spaces(F.substring_index(flat, f" {p} ", 1))))
        lasts.append(F.when(there, spaces(flat) - 1 - spaces(F.substring_index(flat, f" {p} ", -1)) - len(p.split())))
    return {
        "n_base": sum(counts[1:], counts[0]).cast("long"),
        "first_word": F.least(*firsts),
        "last_word": F.greatest(*lasts),
        "_base": F.array_distinct(F.array_compact(F.array(*[F.when(flat.contains(f" {p} "), label) for p, label in PHRASES]))),
    }


def _declared_weight(hit: Column) -> Column:
    """Weight of a declaration by the way in which it declares."""
    bare = F.regexp_replace(hit, "[0-9]+:", "")
    out = F.lit(DECLARATIONS[-1][1])
    for said, weight in reversed(DECLARATIONS[:-1]):
        out = F.when(bare.rlike(f"^ {said} "), F.lit(weight)).otherwise(out)
    return out


def _settled(found: Column) -> Column:
    """One sweep over detections sorted by (begin, -end, rule): what overlaps a better one goes.

    An accumulator is copied at every step, so one that grows with the matches would cost their square.  The sweep runs
    over chunks of about n ** (1/3): a first pass, which only holds the open detection, tells with which one each chunk
    begins; a second pass lets every chunk list what it closes.
    """
    none = F.filter(found, lambda d: F.lit(False))

    def apart(last: Column, d: Column) -> Column:
        return last.isNull() | (d["begin"] >= -last["minus_end"])

    def better(last: Column, d: Column) -> Column:
        return (d["tier"] < last["tier"]) | ((d["tier"] == last["tier"]) & (d["minus_end"] < last["minus_end"]) & (d["rank"] < last["rank"]))

    def open_after(last: Column, d: Column) -> Column:
        return F.when(apart(last, d) | better(last, d), d).otherwise(last)

    def closing(s: Column, d: Column) -> Column:
        closed = apart(s["last"], d) & s["last"].isNotNull()
        return F.struct(open_after(s["last"], d).alias("last"), F.when(closed, F.concat(s["out"], F.array(s["last"]))).otherwise(s["out"]).alias("out"))

    def over(chunks: Column) -> Column:
        begun = F.aggregate(
            chunks, F.struct(F.get(none, F.lit(0)).alias("last"), none.alias("out")),
            lambda s, c: F.struct(F.aggregate(c, s["last"], open_after).alias("last"), F.concat(s["out"], F.array(s["last"])).alias("out")),
            lambda s: F.concat(s["out"], F.array(s["last"])),
        )
        return bind(begun, lambda b: F.concat(
            F.flatten(F.transform(chunks, lambda c, i: F.aggregate(c, F.struct(F.get(b, i).alias("last"), none.alias("out")), closing, lambda s: s["out"]))), F.array(F.element_at(b, -1))))

    size = F.greatest(F.lit(16), F.ceil(F.cbrt(F.size(found))).cast("int"))
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(found) - 1) / size).cast("int")), lambda i: F.slice(found, i * size + 1, size))
    return bind(chunks, over)


def matching_rules(flat: Column, held: Column, rules: list[Signature]) -> Column:
    """Rules whose keyword is among the text's (``held``) and whose needle is in the text."""
    # One text literal that the optimizer folds into an array; a column for each rule would make planning slow.
    listed = json.dumps([{"rank": i, "tier": r.tier, "keyword": r.keyword, "needle": r.needle, "pattern": numbered(r.pattern), "weight": r.weight} for i, r in enumerate(rules)])
    table = F.from_json(F.lit(listed), "array<struct<rank: int, tier: int, keyword: string, needle: string, pattern: string, weight: double>>")
    return F.filter(table, lambda r: F.array_contains(held, r["keyword"]) & flat.contains(r["needle"]))


def detections(matching: Column, words: Column, rules: list[Signature]) -> Column:
    """Detections that no better one overlaps, by start: (begin, end, rule, label, weight), places in words.

    ``words`` is the text with numbered words, so that a match begins with the number of its first word.
    """
    labels = F.from_json(F.lit(json.dumps([r.label for r in rules])), "array<string>")

    def of_rule(r: Column) -> Column:
        def hit(h: Column) -> Column:
            begin = F.substring_index(F.substring(h, 2, 12), ":", 1).cast("int")
            weight = F.when(r["tier"] == DECLARED, _declared_weight(h)).otherwise(r["weight"])
            return F.struct(begin.alias("begin"), (-(begin + spaces(h).cast("int"))).alias("minus_end"), r["rank"].alias("rank"), r["tier"].alias("tier"), weight.alias("weight"))

        return F.transform(F.regexp_extract_all(words, r["pattern"], F.lit(0)), hit)

    sorted_ = F.sort_array(F.flatten(F.transform(matching, of_rule)))
    kept = bind(sorted_, lambda found: F.when(F.size(found) > 0, _settled(found)).otherwise(found))
    return F.transform(kept, lambda d: F.struct(d["begin"].alias("begin"), (-d["minus_end"]).alias("end"), d["rank"].alias("rule"), F.get(labels, d["rank"]).alias("label"), d["weight"].alias("weight")))


def numbered_words(flat: Column) -> Column:
    """`` word word `` as `` 0:word 1:word ``."""
    return F.concat(F.lit(" "), F.array_join(F.transform(F.split(F.trim(flat), " "), lambda w, i: F.concat(i.cast("string"), F.lit(":"), w)), " "), F.lit(" "))


def scan_licenses(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, rules: list[Signature] | None = None) -> DataFrame:
    """``keep`` columns (all by default), the counted phrases, ``labels``, ``score`` and the ``detections``."""
    rules = signatures() if rules is None else rules
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ADDED]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    picked = docs.select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(kept)], text.alias("_text"))
    keys = [f"_k{i}" for i in range(len(kept))]
    flat = F.col("_flat")
    split = picked.select(*keys, normalised(F.col("_text")).alias("_flat"))
    known = split.select(*keys, "_flat", F.array_intersect(F.split(flat, " "), F.array(*map(F.lit, keywords(rules)))).alias("_held"))
    gated = known.select(*keys, "_flat", "_held", (F.size("_held") > 0).alias("_gate"))
    based = gated.select(*keys, "_flat", "_held", "_gate", F.when(flat == "  ", F.lit(0)).otherwise(spaces(flat) - 1).cast("long").alias("n_words"), *[F.when(F.col("_gate"), v).alias(k) for k, v in base_places(flat).items()])
    tried = based.withColumn("_rules", F.when(F.col("_gate"), matching_rules(flat, F.col("_held"), rules)))
    listed = tried.withColumn("_words", F.when(F.size("_rules") > 0, numbered_words(flat)))
    found = listed.withColumn("detections", F.when(F.size("_rules") > 0, detections(F.col("_rules"), F.col("_words"), rules)))
    empty = F.array().cast("array<string>")
    base = F.coalesce("_base", empty)
    own = F.coalesce(F.transform("detections", lambda d: d["label"]), empty)
    joined = found.select(*keys, "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word", base.alias("_base"), own.alias("_own"), "detections")
    weights = F.transform("detections", lambda d: d["weight"])
    return joined.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(kept)], "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.sort_array("_base"), ",").alias("base_labels"), F.array_join(F.sort_array(F.array_distinct(F.concat("_base", "_own"))), ",").alias("labels"),
        F.coalesce(F.array_max(weights), F.when(F.size("_base") > 0, F.lit(0.5)), F.lit(0.0)).alias("score"), "detections",
    )
