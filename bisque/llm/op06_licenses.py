"""License scans: ordered signature rules.

A text is gated by the rules' own names and sentences, looked for in raw text; what passes is reduced to its words, lower case, single spaces. Every
rule has a keyword, a part of whatever its regex matches, that the words must contain before its regex is tried, a label, a priority and a confidence. Rules give intervals; an interval that lies within another of a higher
priority, or of the same priority and greater length (or the same length and an earlier rule), is suppressed.

Only SQL functions are used and rows never meet, so there is no shuffle.

Defined results: null and empty texts have no words and no labels, empty label strings, score 0 and null word positions; repeated rows get
equal results; an empty table gives an empty result; clashing input columns are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: A character of a word, after A-Z are lower case; and of raw text.
IN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
IN_RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Phrases that always count, and their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
VERSION = r"(?:v|version )?"
#: Fixed values, written by hand: label, the keyword of the rule, the license's name as a regex over lower-case words.
NAMES = (
    ("mit", "mit", r"mit licen[cs]e"), ("mit", "expat", r"expat licen[cs]e"), ("mit", "x11", r"x11 licen[cs]e"), ("mit", "mit", r"licen[cs]e mit"),
    ("mit-0", "attribution", r"mit no attribution(?: licen[cs]e)?"), ("mit-0", "mit", r"mit 0"),
    ("apache-2", "apache", rf"apache(?: software)? licen[cs]e {VERSION}2(?: 0)?"), ("apache-2", "apache", rf"apache {VERSION}2(?: 0)?(?: licen[cs]e)?"), ("apache-2", "asl", r"asl {V}2(?: 0)?"),
    ("apache-1.1", "apache", r"apache(?: software)? licen[cs]e {V}1 1"), ("apache-1.0", "apache", r"apache(?: software)? licen[cs]e {V}1 0"), ("apache", "apache", r"apache(?: software)? licen[cs]e"),
    ("bsd-2", "bsd", r"(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd)(?: licen[cs]e)?"), ("bsd-3", "bsd", r"(?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|revised bsd|modified bsd)(?: licen[cs]e)?"),
    ("bsd-4", "bsd", r"(?:bsd 4 clause|4 clause bsd|original bsd|old bsd)(?: licen[cs]e)?"), ("bsd-0", "bsd", r"(?:0bsd|zero clause bsd|bsd zero clause)(?: licen[cs]e)?"), ("bsd", "bsd", r"bsd(?: style| like)? licen[cs]e"),
    ("gpl-3", "gnu", r"gnu general public licen[cs]e {V}3(?: 0)?"), ("gpl-3", "gpl", r"(?:gnu )?gpl ?{V}3(?: 0)?(?: only| or later)?"), ("gpl-3", "gplv3", r"gplv3"),
    ("gpl-2", "gnu", r"gnu general public licen[cs]e {V}2(?: 0)?"), ("gpl-2", "gpl", r"(?:gnu )?gpl ?{V}2(?: 0)?(?: only| or later)?"), ("gpl-2", "gplv2", r"gplv2"),
    ("gpl-1", "gnu", r"gnu general public licen[cs]e {V}1(?: 0)?"), ("gpl", "gnu", r"gnu general public licen[cs]e"), ("gpl", "gnu", r"gnu gpl"), ("gpl", "gpl", r"gpl licen[cs]e"),
    ("lgpl-3", "lesser", r"gnu lesser general public licen[cs]e {V}3(?: 0)?"), ("lgpl-3", "lgpl", r"lgpl ?{V}3(?: 0)?"), ("lgpl-2.1", "lesser", r"gnu lesser general public licen[cs]e {V}2 1"), ("lgpl-2.1", "lgpl", r"lgpl ?{V}2 1"),
    ("lgpl-2", "library", r"gnu library general public licen[cs]e(?: {V}2(?: 0)?)?"), ("lgpl", "lesser", r"(?:gnu )?lesser general public licen[cs]e"), ("lgpl", "lgpl", r"(?:gnu )?lgpl"),
    ("agpl-3", "affero", r"gnu affero general public licen[cs]e {V}3(?: 0)?"), ("agpl-3", "agpl", r"(?:gnu )?agpl ?{V}3(?: 0)?"), ("agpl-1", "affero", r"affero general public licen[cs]e {V}1(?: 0)?"), ("agpl", "affero", r"(?:gnu )?affero general public licen[cs]e"), ("agpl", "agpl", r"(?:gnu )?agpl"),
    ("gfdl-1.3", "documentation", r"gnu free documentation licen[cs]e {V}1 3"), ("gfdl-1.2", "documentation", r"gnu free documentation licen[cs]e {V}1 2"), ("gfdl", "documentation", r"gnu free documentation licen[cs]e"), ("gfdl", "gfdl", r"gfdl"),
    ("mpl-2", "mozilla", r"mozilla public licen[cs]e {V}2(?: 0)?"), ("mpl-2", "mpl", r"mpl ?{V}2(?: 0)?"), ("mpl-1.1", "mozilla", r"mozilla public licen[cs]e {V}1 1"), ("mpl-1.1", "mpl", r"mpl ?{V}1 1"), ("mpl", "mozilla", r"mozilla public licen[cs]e"),
    ("epl-2", "eclipse", r"eclipse public licen[cs]e {V}2(?: 0)?"), ("epl-1", "eclipse", r"eclipse public licen[cs]e {V}1(?: 0)?"), ("epl", "eclipse", r"eclipse public licen[cs]e"), ("edl-1", "eclipse", r"eclipse distribution licen[cs]e"),
    ("cddl-1.1", "development", r"common development and distribution licen[cs]e {V}1 1"), ("cddl-1", "development", r"common development and distribution licen[cs]e {V}1 0"), ("cddl", "development", r"common development and distribution licen[cs]e"), ("cddl", "cddl", r"cddl"),
    ("cpl-1", "common", r"common public licen[cs]e"), ("cpal-1", "attribution", r"common public attribution licen[cs]e"), ("ibm-pl", "ibm", r"ibm public licen[cs]e"), ("eupl-1.2", "european", r"european union public licen[cs]e {V}1 2"), ("eupl", "european", r"european union public licen[cs]e"), ("eupl", "eupl", r"eupl"),
    ("isc", "isc", r"isc licen[cs]e"), ("zlib", "zlib", r"zlib(?: libpng)? licen[cs]e"), ("libpng", "libpng", r"libpng licen[cs]e"), ("boost-1", "boost", r"boost software licen[cs]e(?: {V}1(?: 0)?)?"), ("artistic-2", "artistic", r"artistic licen[cs]e {V}2(?: 0)?"), ("artistic-1", "artistic", r"artistic licen[cs]e {V}1(?: 0)?"), ("artistic", "artistic", r"artistic licen[cs]e"),
    ("unlicense", "unlicense", r"(?:the )?unlicense"), ("wtfpl", "wtfpl", r"wtfpl"), ("wtfpl", "want", r"do what the fuck you want to public licen[cs]e"), ("cc0", "cc0", r"cc0(?: 1 0)?(?: universal)?"), ("cc0", "cc", r"cc (?:zero|0)(?: 1 0)?"), ("cc0", "zero", r"creative commons zero"),
    ("cc-by-nc-nd", "cc", r"cc by nc nd(?: [1-4] [05])?"), ("cc-by-nc-sa", "cc", r"cc by nc sa(?: [1-4] [05])?"), ("cc-by-nc", "cc", r"cc by nc(?: [1-4] [05])?"), ("cc-by-nd", "cc", r"cc by nd(?: [1-4] [05])?"), ("cc-by-sa", "cc", r"cc by sa(?: [1-4] [05])?"), ("cc-by", "cc", r"cc by(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "deriv", r"creative commons attribution non ?commercial no ?deriv(?:s|atives)(?: [1-4] [05])?"), ("cc-by-nc-sa", "alike", r"creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?"), ("cc-by-nc", "commercial", r"creative commons attribution non ?commercial(?: [1-4] [05])?"),
    ("cc-by-nd", "deriv", r"creative commons attribution no ?deriv(?:s|atives)(?: [1-4] [05])?"), ("cc-by-sa", "alike", r"creative commons attribution share ?alike(?: [1-4] [05])?"), ("cc-by", "creative", r"creative commons attribution(?: [1-4] [05])?"), ("cc", "creative", r"creative commons(?: licen[cs]e)?"),
    ("odbl", "open", r"open data(?:base)? (?:commons )?(?:open )?(?:database )?licen[cs]e"), ("odc-by", "open", r"open data commons attribution licen[cs]e"), ("pddl", "dedication", r"(?:open data commons )?public domain dedication(?: and licen[cs]e)?"), ("ofl-1.1", "font", r"(?:sil )?open font licen[cs]e(?: {V}1 1)?"), ("ofl-1.1", "ofl", r"ofl 1 1"),
    ("psf", "python", r"python software foundation licen[cs]e(?: {V}2)?"), ("psf", "psf", r"psf licen[cs]e"), ("python", "python", r"python licen[cs]e"), ("php-3", "php", r"php licen[cs]e(?: {V}3 0?1)?"), ("ruby", "ruby", r"ruby licen[cs]e"), ("perl", "perl", r"same terms as perl itself"), ("openssl", "openssl", r"openssl licen[cs]e"), ("curl", "curl", r"curl licen[cs]e"),
    ("ncsa", "illinois", r"university of illinois(?: ncsa)? open source licen[cs]e"), ("ncsa", "ncsa", r"ncsa licen[cs]e"), ("w3c", "w3c", r"w3c software(?: notice and)? licen[cs]e"), ("qpl", "public", r"q public licen[cs]e"), ("ms-pl", "microsoft", r"microsoft public licen[cs]e"), ("ms-rl", "microsoft", r"microsoft reciprocal licen[cs]e"), ("osl-3", "open", r"open software licen[cs]e(?: {V}3(?: 0)?)?"), ("afl-3", "academic", r"academic free licen[cs]e(?: {V}3(?: 0)?)?"), ("ecl-2", "educational", r"educational community licen[cs]e(?: {V}2(?: 0)?)?"),
    ("sspl-1", "server", r"server side public licen[cs]e(?: {V}1)?"), ("busl-1.1", "business", r"business source licen[cs]e(?: {V}1 1)?"), ("elastic-2", "elastic", r"elastic licen[cs]e(?: {V}2(?: 0)?)?"), ("commons-clause", "clause", r"commons clause"), ("polyform-nc", "polyform", r"polyform noncommercial licen[cs]e"), ("rail", "responsible", r"(?:open )?responsible ai licen[cs]e"), ("openrail", "openrail", r"(?:creativeml )?openrail(?: m)?"), ("llama", "llama", r"llama(?: [23])? community licen[cs]e"),
    ("mulan-2", "mulan", r"mulan (?:psl|permissive software licen[cs]e)(?: {V}2)?"), ("upl-1", "universal", r"universal permissive licen[cs]e"), ("vim", "vim", r"vim licen[cs]e"), ("beerware", "beer", r"beer ?ware licen[cs]e"), ("json", "evil", r"shall be used for good not evil"), ("postgresql", "postgresql", r"postgresql licen[cs]e"), ("unicode", "unicode", r"unicode licen[cs]e(?: {V}3)?"), ("imagemagick", "imagemagick", r"imagemagick licen[cs]e"), ("freetype", "freetype", r"freetype (?:project )?licen[cs]e"), ("ijg", "jpeg", r"independent jpeg group licen[cs]e"), ("sleepycat", "sleepycat", r"sleepycat licen[cs]e"), ("blueoak", "oak", r"blue oak model licen[cs]e"), ("lppl", "latex", r"latex project public licen[cs]e(?: {V}1 3c?)?"), ("nasa", "nasa", r"nasa open source agreement"), ("cecill", "cecill", r"cecill(?: {V}2(?: [01])?)?"), ("ogl-3", "government", r"open government licen[cs]e(?: {V}3(?: 0)?)?"),
)
#: Sentences of license texts and notices; label, keyword, regex, confidence.
SENTENCES = (
    ("mit", "hereby", r"permission is hereby granted free of charge to any person obtaining a copy", 1.0), ("mit", "warranty", r"the software is provided as is without warranty of any kind express or implied", 0.8),
    ("apache-2", "compliance", r"you may not use this file except in compliance with the licen[cs]e", 0.9), ("bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted", 0.9), ("bsd-3", "endorse", r"may be used to endorse or promote products derived from this software", 0.9),
    ("bsd-4", "advertising", r"all advertising materials mentioning features or use of this software must display", 0.9), ("gpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e", 1.0), ("lgpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu lesser general public licen[cs]e", 1.0), ("agpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu affero general public licen[cs]e", 1.0),
    ("isc", "permission", r"permission to use copy modify and or distribute this software for any purpose", 0.9), ("zlib", "misrepresented", r"the origin of this software must not be misrepresented", 0.9), ("boost-1", "boost", r"distributed under the boost software licen[cs]e", 1.0), ("mpl-2", "mozilla", r"this source code form is subject to the terms of the mozilla public licen[cs]e", 1.0), ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain", 1.0),
    ("gpl", "fitness", r"without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public licen[cs]e", 1.0), ("gpl", "foundation", r"write to the free software foundation inc (?:59 temple place|51 franklin street|675 mass ave)", 0.7),
    ("gpl", "copy", r"you should have received a copy of the gnu general public licen[cs]e", 1.0), ("lgpl", "copy", r"you should have received a copy of the gnu (?:lesser|library) general public licen[cs]e", 1.0), ("agpl", "copy", r"you should have received a copy of the gnu affero general public licen[cs]e", 1.0),
    ("gpl", "copies", r"everyone is permitted to copy and distribute verbatim copies of this licen[cs]e document", 0.8), ("gfdl", "invariant", r"with no invariant sections no front cover texts and no back cover texts", 1.0),
    ("apache-2", "unless", r"unless required by applicable law or agreed to in writing software distributed under the licen[cs]e is distributed on an as is basis", 0.9), ("apache-2", "apache", r"apache org licen[cs]es licen[cs]e 2 0", 1.0),
    ("bsd", "above", r"redistributions of source code must retain the above copyright notice", 0.9), ("bsd", "binary", r"redistributions in binary form must reproduce the above copyright notice", 0.9), ("bsd", "contributors", r"this software is provided by the copyright holders and contributors as is", 0.8),
    ("bsd-3", "contributors", r"nor the names of its contributors may be used to endorse", 0.9), ("bsd", "governed", r"governed by a bsd style licen[cs]e", 1.0), ("mit", "substantial", r"shall be included in all copies or substantial portions of the software", 0.9),
    ("mit", "opensource", r"opensource org licen[cs]es mit", 1.0), ("bsd-3", "opensource", r"opensource org licen[cs]es bsd 3 clause", 1.0), ("gpl-3", "gnu", r"gnu org licen[cs]es gpl 3 0", 1.0), ("gpl-2", "gnu", r"gnu org licen[cs]es (?:old licen[cs]es )?gpl 2 0", 1.0), ("agpl-3", "gnu", r"gnu org licen[cs]es agpl 3 0", 1.0),
    ("isc", "above", r"provided that the above copyright notice and this permission notice appear in all copies", 0.9), ("mpl-2", "mozilla", r"mozilla org mpl 2 0", 1.0), ("epl-2", "accompanying", r"this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e 2 0", 1.0),
    ("zlib", "alter", r"permission is granted to anyone to use this software for any purpose including commercial applications and to alter it", 1.0), ("boost-1", "boost", r"boost org licen[cs]e 1 0", 1.0), ("wtfpl", "fuck", r"you just do what the fuck you want to", 1.0), ("beerware", "beer", r"you can buy me a beer in return", 1.0), ("unlicense", "anyone", r"anyone is free to copy modify publish use compile sell or distribute this software", 1.0),
    ("ofl-1.1", "reserved", r"reserved font name", 0.7), ("sspl-1", "mongodb", r"mongodb com licensing server side public licen[cs]e", 1.0), ("busl-1.1", "change", r"change licen[cs]e apache licen[cs]e", 0.7), ("commons-clause", "sell", r"does not grant to you the right to sell the software", 1.0), ("json", "good", r"the software shall be used for good", 0.8),
    ("cc-by", "creativecommons", r"creativecommons org licen[cs]es by [1-4] [05]", 1.0), ("cc-by-sa", "creativecommons", r"creativecommons org licen[cs]es by sa [1-4] [05]", 1.0), ("cc-by-nd", "creativecommons", r"creativecommons org licen[cs]es by nd [1-4] [05]", 1.0), ("cc-by-nc", "creativecommons", r"creativecommons org licen[cs]es by nc [1-4] [05]", 1.0),
    ("cc-by-nc-sa", "creativecommons", r"creativecommons org licen[cs]es by nc sa [1-4] [05]", 1.0), ("cc-by-nc-nd", "creativecommons", r"creativecommons org licen[cs]es by nc nd [1-4] [05]", 1.0), ("cc0", "creativecommons", r"creativecommons org publicdomain zero 1 0", 1.0), ("cc0", "waived", r"has waived all copyright and related or neighboring rights", 1.0),
    ("mit", "mit", r"osi approved mit licen[cs]e", 1.0), ("apache-2", "apache", r"osi approved apache software licen[cs]e", 1.0), ("bsd", "bsd", r"osi approved bsd licen[cs]e", 1.0), ("gpl", "gnu", r"osi approved gnu general public licen[cs]e", 1.0), ("psf", "python", r"osi approved python software foundation licen[cs]e", 1.0),
    ("mit", "mit", r"veröffentlicht unter der mit lizenz", 1.0), ("gpl", "gpl", r"unter der gpl lizenz", 0.9), ("cc", "creative", r"creative commons lizenz", 0.7), ("mit", "mit", r"sous licence mit", 1.0), ("gpl", "gpl", r"sous licence (?:gnu )?gpl", 1.0), ("apache", "apache", r"sous licence apache", 1.0), ("mit", "mit", r"bajo la licencia mit", 1.0), ("gpl", "gpl", r"bajo la licencia (?:gnu )?gpl", 1.0), ("apache", "apache", r"bajo la licencia apache", 1.0),
    ("all-rights-reserved", "rechte", r"alle rechte vorbehalten", 0.4), ("all-rights-reserved", "droits", r"tous droits réservés", 0.4), ("all-rights-reserved", "derechos", r"todos los derechos reservados", 0.4), ("proprietary", "trade", r"contains trade secrets", 0.5), ("proprietary", "evaluation", r"for evaluation (?:purposes )?only", 0.4), ("non-commercial", "commercial", r"for non ?commercial use only", 0.6), ("research-only", "research", r"for research (?:purposes|use) only", 0.6), ("academic", "academic", r"for academic (?:purposes|use) only", 0.6),
    ("public-domain", "domain", r"(?:dedicated|released|placed) (?:in|in ?to|to) the public domain", 0.9), ("public-domain", "domain", r"public domain", 0.4), ("all-rights-reserved", "reserved", r"all rights reserved", 0.4), ("proprietary", "confidential", r"proprietary and confidential", 0.8), ("proprietary", "unauthorized", r"unauthorized copying of this file", 0.8), ("copyleft", "copyleft", r"copyleft", 0.3),
)
#: Fixed values, written by hand: label and the identifier of a license as words, after ``SPDX-License-Identifier:``.
SPDX = (
    ("mit", "mit"), ("mit-0", "mit 0"), ("isc", "isc"), ("zlib", "zlib"), ("libpng", "libpng 2 0"), ("boost-1", "bsl 1 0"), ("epl-1", "epl 1 0"), ("epl-2", "epl 2 0"), ("postgresql", "postgresql"), ("artistic-1", "artistic 1 0"), ("artistic-2", "artistic 2 0"),
    ("psf", "psf 2 0"), ("python", "python 2 0"), ("apache-1.0", "apache 1 0"), ("apache-1.1", "apache 1 1"), ("apache-2", "apache 2 0"), ("bsd-0", "0bsd"), ("bsd-2", "bsd 2 clause"), ("bsd-3", "bsd 3 clause"), ("bsd-4", "bsd 4 clause"), ("bsd-2", "bsd 2 clause patent"), ("bsd-3", "bsd 3 clause clear"),
    ("gpl-1", "gpl 1 0"), ("gpl-2", "gpl 2 0"), ("gpl-2", "gpl 2 0 only"), ("gpl-2", "gpl 2 0 or later"), ("gpl-3", "gpl 3 0"), ("gpl-3", "gpl 3 0 only"), ("gpl-3", "gpl 3 0 or later"), ("lgpl-2", "lgpl 2 0 only"), ("lgpl-2", "lgpl 2 0 or later"), ("lgpl-2.1", "lgpl 2 1"), ("lgpl-2.1", "lgpl 2 1 only"), ("lgpl-2.1", "lgpl 2 1 or later"),
    ("lgpl-3", "lgpl 3 0"), ("lgpl-3", "lgpl 3 0 only"), ("lgpl-3", "lgpl 3 0 or later"), ("agpl-1", "agpl 1 0"), ("agpl-3", "agpl 3 0"), ("agpl-3", "agpl 3 0 only"), ("agpl-3", "agpl 3 0 or later"), ("gfdl-1.2", "gfdl 1 2"), ("gfdl-1.3", "gfdl 1 3"), ("mpl-1.1", "mpl 1 1"), ("mpl-2", "mpl 2 0"),
    ("cddl-1", "cddl 1 0"), ("cddl-1.1", "cddl 1 1"), ("cpl-1", "cpl 1 0"), ("cpal-1", "cpal 1 0"), ("ibm-pl", "ipl 1 0"), ("eupl", "eupl 1 1"), ("eupl-1.2", "eupl 1 2"), ("unlicense", "unlicense"), ("wtfpl", "wtfpl"), ("cc0", "cc0 1 0"), ("cc-by", "cc by [1-4] [05]"), ("cc-by-sa", "cc by sa [1-4] [05]"), ("cc-by-nd", "cc by nd [1-4] [05]"),
    ("cc-by-nc", "cc by nc [1-4] [05]"), ("cc-by-nc-sa", "cc by nc sa [1-4] [05]"), ("cc-by-nc-nd", "cc by nc nd [1-4] [05]"), ("odbl", "odbl 1 0"), ("odc-by", "odc by 1 0"), ("pddl", "pddl 1 0"), ("ofl-1.1", "ofl 1 1"), ("php-3", "php 3 01"), ("ruby", "ruby"), ("openssl", "openssl"), ("curl", "curl"), ("ncsa", "ncsa"), ("w3c", "w3c"), ("qpl", "qpl 1 0"),
    ("ms-pl", "ms pl"), ("ms-rl", "ms rl"), ("osl-3", "osl 3 0"), ("afl-3", "afl 3 0"), ("ecl-2", "ecl 2 0"), ("sspl-1", "sspl 1 0"), ("busl-1.1", "busl 1 1"), ("elastic-2", "elastic 2 0"), ("polyform-nc", "polyform noncommercial 1 0 0"), ("mulan-2", "mulanpsl 2 0"), ("upl-1", "upl 1 0"), ("vim", "vim"), ("beerware", "beerware"), ("json", "json"),
    ("unicode", "unicode 3 0"), ("imagemagick", "imagemagick"), ("freetype", "ftl"), ("ijg", "ijg"), ("sleepycat", "sleepycat"), ("blueoak", "blueoak 1 0 0"), ("lppl", "lppl 1 3c"), ("nasa", "nasa 1 3"), ("cecill", "cecill 2 [01]"), ("x11", "x11"),
)
ACT = r"(?:licen[cs]ed|released|distributed|available|covered|provided|published|offered|shared|made available|redistributed)"
#: How a name may be given: prefix regex, suffix regex, priority, confidence.
FORMS = (
    (rf"{ACT} under (?:the )?(?:terms of (?:the )?)?(?:conditions of (?:the )?)?", "", 30, 1.0),
    (r"", "", 10, 0.6),
)


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    regex: str
    priority: int
    score: float


def rules() -> list[Rule]:
    out = []
    for label, keyword, name in NAMES:
        name = name.replace("{V}", VERSION)
        # of two names of one form the longer, more special one wins by length; the order settles ties
        out += [Rule(label, keyword, f"(?<= ){a}{name}{b}(?= )", p, s) for a, b, p, s in FORMS]
    out += [Rule(label, "spdx license identifier", f"(?<= )spdx license identifier {name}(?= )", 40, 1.0) for label, name in SPDX]
    out += [Rule(label, keyword, f"(?<= ){r}(?= )", 20, s) for label, keyword, r, s in SENTENCES]
    for r in out:
        re.compile(r.regex)
    return out


def cores(regex: str) -> list[str]:
    """The regex without its optional groups, one for each choice of its alternatives."""
    m = re.search(r"\(\?:([^()]*)\)(\??)", regex)
    if not m:
        return [regex]
    return [c for part in ([""] if m[2] else m[1].split("|")) for c in cores(regex[: m.start()] + part + regex[m.end() :])]


def _gate(low: Column) -> Column:
    """Whether a rule may match the text ``low``, in lower case: "licen", or a name or sentence that can do without it."""
    given = [(k, r.replace("{V}", VERSION)) for _, k, r in NAMES] + [(k, r) for _, k, r, _ in SENTENCES] + [(p.split()[-1], p) for p, _ in BASE]
    found: dict[str, list[str]] = {}
    for k, r in given:
        if not all("licen" in c for c in cores(r)):
            raw = re.sub(r" (\??)", lambda m: f"(?:{BETWEEN}){m[1]}", r)
            found.setdefault(k, []).append(raw)
    gate = low.contains("licen")
    for k, raw in found.items():
        gate = gate | low.contains(k) & low.rlike("|".join(raw))
    return gate


def _quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _table(rows: list[Rule]) -> str:
    one = lambda i, r: f"named_struct('no',{i},'label',{_quoted(r.label)},'kw',{_quoted(r.keyword)},'re',{_quoted(r.regex)},'prio',{r.priority},'score',cast({r.score} as double))"
    return "array(" + ",".join(one(i, r) for i, r in enumerate(rows)) + ")"


def _hits(table: str) -> str:
    """SQL: the intervals of a rule table's matches in ``norm__``, an array of structs."""
    kind = "array<struct<no:int,label:string,prio:int,score:double,s:int,e:int>>"
    found = "regexp_extract_all(norm__, r.re, 0)"
    gaps = f"transform(slice(split(norm__, r.re, -1), 1, size({found})), x -> length(x))"
    return f"""flatten(transform(filter({table}, r -> contains(norm__, r.kw)), r -> aggregate(
        zip_with({gaps}, transform({found}, x -> length(x)), (g, l) -> named_struct('g', g, 'l', l)),
        named_struct('at', 0, 'out', cast(array() as {kind})),
        (acc, x) -> named_struct('at', acc.at + x.g + x.l, 'out', concat(acc.out, array(named_struct(
            'no', r.no, 'label', r.label, 'prio', r.prio, 'score', r.score, 's', acc.at + x.g, 'e', acc.at + x.g + x.l)))),
        acc -> acc.out)))"""


def scan(df: DataFrame, column: str = "text") -> DataFrame:
    """``df`` with n_words, n_base, first_word, last_word, base_labels, labels, score and ``detections`` (label, score, first and last word)."""
    new = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections", "norm__", "hits__", "base__", "kept__", "low__", "text__"]
    src = df.withColumn("text__", F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("")))
    df = common.without(src, new[:-1])
    keep = [c for c in df.columns if c != "text__"]
    base = [Rule(label, p.split()[-1], f"(?<= ){p}(?= )", 0, 1.0) for p, label in BASE]
    df = df.withColumn("n_words", F.when(F.col("text__") == "", 0).otherwise(F.regexp_count("text__", F.lit(f"{IN_RAW_WORD}+"))).cast("long"))
    words = F.concat(F.lit(" "), F.array_join(F.regexp_extract_all(common.lower_az(F.col("text__")), F.lit(f"({IN_WORD}+)"), F.lit(1)), " "), F.lit(" "))
    df = df.withColumn("low__", F.lower("text__")).withColumn("norm__", F.when(_gate(F.col("low__")), words)).drop("text__", "low__")
    none = "cast(array() as array<struct<no:int,label:string,prio:int,score:double,s:int,e:int>>)"
    df = df.withColumn("base__", F.expr(f"case when norm__ is null then {none} else {_hits(_table(base))} end"))
    df = df.withColumn("hits__", F.expr(f"case when norm__ is null then {none} else {_hits(_table(rules()))} end"))
    covers = "o.s <= h.s and o.e >= h.e and (o.prio > h.prio or o.prio = h.prio and (o.e - o.s > h.e - h.s or o.e - o.s = h.e - h.s and o.no < h.no))"
    df = df.withColumn("kept__", F.expr(f"filter(hits__, h -> not exists(hits__, o -> {covers}))"))
    place = "cast(length(left(norm__, h.s)) - length(replace(left(norm__, h.s), ' ', '')) - 1 as bigint)"
    last = "cast(length(left(norm__, h.e)) - length(replace(left(norm__, h.e), ' ', '')) - 1 as bigint)"
    return df.select(
        *[F.col(f"`{c}`") for c in keep], "n_words", F.size("base__").cast("long").alias("n_base"),
        F.expr(f"array_min(transform(base__, h -> {place}))").alias("first_word"), F.expr(f"array_max(transform(base__, h -> {place}))").alias("last_word"),
        F.expr("array_join(array_sort(array_distinct(transform(base__, h -> h.label))), ',')").alias("base_labels"),
        F.expr("array_join(array_sort(array_distinct(concat(transform(base__, h -> h.label), transform(kept__, h -> h.label)))), ',')").alias("labels"),
        F.expr("greatest(coalesce(array_max(transform(kept__, h -> h.score)), 0D), if(size(base__) > 0, 1D, 0D))").alias("score"),
        F.expr(f"transform(kept__, h -> named_struct('label', h.label, 'score', h.score, 'first_word', {place}, 'last_word', {last}))").alias("detections"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan(docs).drop("text", "detections")
