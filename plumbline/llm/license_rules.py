"""Signature rules of license texts: (label, priority, keyword, pattern, confidence).

Patterns are regular expressions over words in lower case with one blank between them; a match begins and ends at
word edges. The keyword is a literal that every match holds. Of two detections
of which one lies inside the other, the one of lower priority gives way.
"""

from __future__ import annotations

from itertools import product
from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    priority: int
    keyword: str
    pattern: str
    confidence: float
    base: bool = False


#: fixed values of the contract: phrases that are always reported, wherever they stand
BASE = [
    Rule("cc-by", 0, "cc by", "cc by", 0.5, True),
    Rule("gpl", 0, "general public license", "general public license", 0.5, True),
    Rule("reserved", 0, "all rights reserved", "all rights reserved", 0.5, True),
]

#: family: (keyword, name, {version: how it is written}); the version is empty where none is told
NAMED = {
    "apache": ("apache", r"apache(?: software)?(?: foundation)? licen[sc]e", {"": "", "1.0": r" (?:v|version )?1 0", "1.1": r" (?:v|version )?1 1", "2.0": r" (?:v|version )?2(?: 0)?"}),
    "mit": ("mit licen", r"mit licen[sc]e", {"": ""}),
    "bsd": ("bsd", r"bsd(?: style)? licen[sc]e", {"": "", "2-clause": r" 2 clause", "3-clause": r" 3 clause", "4-clause": r" 4 clause"}),
    "isc": ("isc licen", r"isc licen[sc]e", {"": ""}),
    "gpl": ("general public", r"(?:gnu )?general public licen[sc]e", {"": "", "1.0": r" (?:v|version )?1(?: 0)?", "2.0": r" (?:v|version )?2(?: 0)?", "3.0": r" (?:v|version )?3(?: 0)?"}),
    "lgpl": ("lesser general", r"(?:gnu )?lesser general public licen[sc]e", {"": "", "2.1": r" (?:v|version )?2 1", "3.0": r" (?:v|version )?3(?: 0)?"}),
    "lgpl-library": ("library general", r"(?:gnu )?library general public licen[sc]e", {"": "", "2.0": r" (?:v|version )?2(?: 0)?"}),
    "agpl": ("affero general", r"(?:gnu )?affero general public licen[sc]e", {"": "", "3.0": r" (?:v|version )?3(?: 0)?"}),
    "gfdl": ("free documentation", r"(?:gnu )?free documentation licen[sc]e", {"": "", "1.2": r" (?:v|version )?1 2", "1.3": r" (?:v|version )?1 3"}),
    "mpl": ("mozilla public", r"mozilla public licen[sc]e", {"": "", "1.1": r" (?:v|version )?1 1", "2.0": r" (?:v|version )?2(?: 0)?"}),
    "epl": ("eclipse public", r"eclipse public licen[sc]e", {"": "", "1.0": r" (?:v|version )?1 0", "2.0": r" (?:v|version )?2(?: 0)?"}),
    "eupl": ("european union public", r"european union public licen[sc]e", {"": "", "1.1": r" (?:v|version )?1 1", "1.2": r" (?:v|version )?1 2"}),
    "cddl": ("common development and distribution", r"common development and distribution licen[sc]e", {"": "", "1.0": r" (?:v|version )?1 0"}),
    "artistic": ("artistic licen", r"artistic licen[sc]e", {"": "", "1.0": r" (?:v|version )?1 0", "2.0": r" (?:v|version )?2(?: 0)?"}),
    "boost": ("boost software", r"boost software licen[sc]e", {"": "", "1.0": r" (?:v|version )?1 0"}),
    "zlib": ("zlib", r"zlib(?: libpng)? licen[sc]e", {"": ""}),
    "unlicense": ("unlicense", r"(?:the )?unlicense", {"": ""}),
    "ofl": ("open font", r"(?:sil )?open font licen[sc]e", {"": "", "1.1": r" (?:v|version )?1 1"}),
    "odbl": ("open database", r"open database licen[sc]e", {"": "", "1.0": r" (?:v|version )?1 0"}),
    "ms-pl": ("microsoft public", r"microsoft public licen[sc]e", {"": ""}),
    "postgresql": ("postgresql licen", r"postgresql licen[sc]e", {"": ""}),
    "python": ("python software foundation", r"python software foundation licen[sc]e", {"": "", "2.0": r" (?:v|version )?2(?: 0)?"}),
    "wtfpl": ("public licen", r"do what the fuck you want to public licen[sc]e", {"": ""}),
    "cc0": ("cc0", r"cc0", {"": "", "1.0": r" (?:v|version )?1 0"}),
}

#: other names of a family, by keywords of their own
ALIASES = [
    ("apache", ("asf", r"asf(?: software)?(?: foundation)? licen[sc]e", NAMED["apache"][2])),
    ("mit", ("expat licen", r"expat licen[sc]e", NAMED["mit"][2])),
]

#: written before a name: (words, priority, confidence)
FORMS = [
    (r"", 1, 0.6),
    (r"(?:is |are )?licensed under (?:the )?(?:terms of )?(?:the )?", 3, 0.95),
    (r"(?:is |are )?(?:re)?(?:released|published) under (?:the )?(?:terms of )?(?:the )?", 3, 0.95),
    (r"(?:re)?distribut(?:e|ed) (?:it )?under (?:the )?(?:terms of )?(?:the )?", 3, 0.9),
    (r"(?:made )?available under (?:the )?(?:terms of )?(?:the )?", 3, 0.9),
    (r"subject to (?:the )?(?:terms of )?(?:the )?", 2, 0.85),
    (r"see (?:the )?", 2, 0.7),
]

ELEMENTS = ["by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd"]
CC_NAMES = {
    "by": "attribution",
    "by sa": "attribution share ?alike",
    "by nd": "attribution no ?deriv(?:ative)?s?",
    "by nc": "attribution non ?commercial",
    "by nc sa": "attribution non ?commercial share ?alike",
    "by nc nd": "attribution non ?commercial no ?deriv(?:ative)?s?",
}
CC_VERSIONS = ["", "1.0", "2.0", "2.5", "3.0", "4.0"]

#: sentences of the license texts themselves and other notices
BODIES = [
    Rule("mit", 4, "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy", 0.98),
    Rule("isc", 4, "permission to use copy", "permission to use copy modify and or distribute this software for any purpose", 0.95),
    Rule("bsd", 4, "redistribution and use", "redistribution and use in source and binary forms with or without modification are permitted", 0.98),
    Rule("bsd-3-clause", 4, "endorse or promote", "endorse or promote products derived from this software without specific prior written permission", 0.9),
    Rule("gpl", 4, "this program is free software", "this program is free software you can redistribute it and or modify it", 0.95),
    Rule("lgpl", 4, "this library is free software", "this library is free software you can redistribute it and or modify it", 0.95),
    Rule("unlicense", 4, "unencumbered software", "this is free and unencumbered software released into the public domain", 0.98),
    Rule("public-domain", 2, "public domain", "(?:released|dedicated) (?:in)?to the public domain", 0.9),
    Rule("public-domain", 1, "public domain", "public domain", 0.4),
    Rule("warranty-disclaimer", 1, "warranty", "without (?:any )?warranty(?: of any kind)?", 0.5),
    Rule("warranty-disclaimer", 2, "provided as is", "provided as is without warranty of any kind", 0.8),
    Rule("copyright", 1, "copyright", "copyright(?: c)?(?: 1[89][0-9]{2}| 20[0-9]{2})(?: 20[0-9]{2})*", 0.4),
    Rule("proprietary", 2, "proprietary", "proprietary and confidential", 0.6),
    Rule("proprietary", 2, "unauthorized", "unauthorized (?:copying|use|reproduction|distribution)", 0.6),
]

SPDX_IDS = {
    "apache 2 0": "apache-2.0", "mit": "mit", "isc": "isc", "bsd 2 clause": "bsd-2-clause", "bsd 3 clause": "bsd-3-clause",
    "gpl 2 0": "gpl-2.0", "gpl 3 0": "gpl-3.0", "lgpl 2 1": "lgpl-2.1", "lgpl 3 0": "lgpl-3.0", "agpl 3 0": "agpl-3.0",
    "mpl 2 0": "mpl-2.0", "epl 2 0": "epl-2.0", "cc0 1 0": "cc0-1.0", "unlicense": "unlicense", "bsl 1 0": "boost-1.0",
}


def rules() -> list[Rule]:
    """All rules, base ones first."""
    found = list(BASE)
    for (family, (keyword, name, versions)), (before, priority, confidence) in product([*NAMED.items(), *ALIASES], FORMS):
        for version, written in versions.items():
            label = f"{family}-{version}" if version else family
            found.append(Rule(label, priority + bool(version), keyword, before + name + written, confidence))
    for elements, version in product(ELEMENTS, CC_VERSIONS):
        label = f"cc-{elements}-{version}".strip("-").replace(" ", "-")
        written = " ".join(["", *version.split(".")]) if version else ""
        specific = 1 + bool(version) + elements.count(" ")
        found.append(Rule(label, specific, "cc by", f"(?:licensed under )?(?:a )?(?:creative commons )?cc {elements}{written}", 0.9))
        found.append(Rule(label, specific, "creative commons", f"creative commons {CC_NAMES[elements]}{written}(?: international)?(?: licen[sc]e)?{written}", 0.9))
    found += BODIES
    found += [Rule(label, 5, "spdx", f"spdx licen[sc]e identifier {id_}(?: or later| only)?", 0.99) for id_, label in SPDX_IDS.items()]
    return found


#: one of these is in the lower-cased text wherever a rule's keyword is in its words
GATES = [
    "licen", "reserved", "apache", "bsd", "general", "documentation", "public", "distribution", "boost", "zlib", "open font", "asf",
    "database", "foundation", "cc0", "creative", "permission", "redistribut", "promote", "software", "domain", "warranty",
    "provided", "copyright", "proprietary", "unauthorized", "spdx",
]
