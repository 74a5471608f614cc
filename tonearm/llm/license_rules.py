"""Signature rules of the license scan, in order.

A rule is (label, priority, keyword, regex, confidence); every match of the regex holds the
keyword, with the space before its first word. Texts are words joined by one
space, all in lower case and without punctuation, and regexes run on them: each starts
at the start of a word and must end at a word's end. Priorities: 3 a license's own
grant or an identifier, 2 a name with version, 1 a name alone, 0 a mere notice.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    priority: int
    keyword: str
    regex: str
    confidence: float


#: Phrases whose places are reported for themselves.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

VERSION = r"(?: version| v)? ?"
GNU = r"(?:the )?(?:gnu )?"
LATER = r" (?:or )?(?:at your option )?(?:any )?later(?: version)?"

GRANTS = [
    ("mit", 3, " permission", r"permission is hereby granted free of charge to any person obtaining a copy", 0.95),
    ("isc", 3, " permission", r"permission to use copy modify and or distribute this software for any purpose", 0.95),
    ("bsd-3-clause", 3, " redistribution", r"redistribution and use in source and binary forms with or without modification are permitted(?: \S+){0,80}? neither the name", 0.95),
    ("bsd-2-clause", 3, " redistribution", r"redistribution and use in source and binary forms with or without modification are permitted", 0.9),
    ("zlib", 3, " warranty", r"provided as is without any express or implied warranty(?: \S+){0,100}? altered source versions", 0.95),
    ("zlib", 3, " permission", r"permission is granted to anyone to use this software for any purpose including commercial applications", 0.95),
    ("bsl-1.0", 3, " permission", r"permission is hereby granted free of charge to any person or organization obtaining a copy", 0.95),
    ("apache-2.0", 3, " licen", r"licensed under the apache license version 2 0", 0.98),
    ("apache-2.0", 3, " licen", r"you may not use this file except in compliance with the license", 0.9),
    ("mpl-2.0", 3, " licen", r"subject to the terms of the mozilla public license v(?:ersion)? ?2 0", 0.98),
    ("mpl-1.1", 3, " licen", r"subject to the mozilla public license version 1 1", 0.98),
    ("unlicense", 3, " public domain", r"this is free and unencumbered software released into the public domain", 0.98),
    ("wtfpl", 3, " public license", r"do what the fuck you want to public license", 0.98),
    ("cc0-1.0", 3, " public domain", r"dedicated (?:the work )?to the public domain by waiving all of (?:his or her|their) rights", 0.9),
    ("gpl", 3, " general public", r"free software you can redistribute it and or modify it under the terms of the gnu general public license", 0.97),
    ("lgpl", 3, " general public", r"free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license", 0.97),
    ("agpl", 3, " general public", r"free software you can redistribute it and or modify it under the terms of the gnu affero general public license", 0.97),
    ("ofl-1.1", 3, " licen", r"this font software is licensed under the sil open font license version 1 1", 0.98),
    ("ms-pl", 3, " licen", r"this license governs use of the accompanying software if you use the software you accept this license", 0.8),
    ("eupl", 3, " licen", r"licensed under the eupl", 0.95),
    ("mit", 3, " licen", r"(?:released|licensed|distributed|available|published) under (?:the )?(?:terms of the )?(?:mit|expat) licen[cs]e", 0.97),
    ("bsd", 3, " licen", r"(?:released|licensed|distributed|available) under (?:the |a )?(?:terms of the )?bsd(?: style)? licen[cs]e", 0.95),
    ("gpl", 3, " licen", rf"(?:released|licensed|distributed|available) under {GNU}(?:gpl|general public license)", 0.95),
    ("public-domain", 3, " public domain", r"(?:placed|released|dedicated|is) (?:in|into|to) the public domain", 0.9),
    ("proprietary", 3, " this software is", r"this software is (?:proprietary|confidential)(?: and (?:proprietary|confidential))?", 0.8),
    ("proprietary", 3, " permission", r"may not be (?:copied|reproduced|distributed)(?: \S+){0,8}? without (?:the )?(?:prior |express )*(?:written )?permission", 0.8),
]

NAMES = [
    ("mit", 1, " mit ", r"mit licen[cs]e", 0.7),
    ("mit", 1, " licen", r"expat licen[cs]e", 0.7),
    ("mit-0", 2, " mit ", r"mit no attribution", 0.8),
    ("x11", 1, " licen", r"x11 licen[cs]e", 0.7),
    ("isc", 1, " licen", r"isc licen[cs]e", 0.7),
    ("zlib", 1, " licen", r"zlib(?: libpng)? licen[cs]e", 0.7),
    ("bsl-1.0", 2, " licen", r"boost software license(?: version 1 0)?", 0.85),
    ("apache", 1, " apache", r"apache (?:software )?(?:foundation )?licen[cs]e", 0.6),
    ("bsd", 1, " bsd", r"bsd(?: style)? licen[cs]e", 0.6),
    ("mpl", 1, " mozilla", r"mozilla public licen[cs]e", 0.6),
    ("epl", 1, " licen", r"eclipse public licen[cs]e", 0.6),
    ("cddl", 1, " licen", r"common development and distribution licen[cs]e", 0.6),
    ("cpl-1.0", 1, " licen", r"common public licen[cs]e", 0.6),
    ("ipl-1.0", 1, " licen", r"ibm public licen[cs]e", 0.6),
    ("eupl", 1, " licen", r"european union public licen[cs]e", 0.6),
    ("artistic", 1, " licen", r"artistic licen[cs]e", 0.6),
    ("ofl", 1, " licen", r"(?:sil )?open font licen[cs]e", 0.6),
    ("odbl", 1, " licen", r"open (?:data commons open )?database licen[cs]e", 0.6),
    ("pddl", 1, " licen", r"public domain dedication and licen[cs]e", 0.6),
    ("psf", 1, " licen", r"(?:python software foundation|psf) licen[cs]e", 0.6),
    ("ruby", 1, " licen", r"ruby licen[cs]e", 0.6),
    ("php", 1, " licen", r"php licen[cs]e", 0.6),
    ("perl", 1, " same terms", r"same terms as perl(?: itself)?", 0.6),
    ("openssl", 1, " licen", r"openssl licen[cs]e", 0.6),
    ("ms-pl", 1, " licen", r"microsoft public licen[cs]e", 0.7),
    ("ms-rl", 1, " licen", r"microsoft reciprocal licen[cs]e", 0.7),
    ("afl", 1, " licen", r"academic free licen[cs]e", 0.6),
    ("osl", 1, " licen", r"open software licen[cs]e", 0.6),
    ("qpl", 1, " licen", r"q public licen[cs]e", 0.6),
    ("wtfpl", 1, " wtfpl", r"wtfpl", 0.6),
    ("unlicense", 1, " unlicense", r"unlicense", 0.6),
    ("gfdl", 1, " licen", rf"{GNU}free documentation licen[cs]e", 0.6),
    ("gpl", 1, " general public", rf"{GNU}general public licen[cs]e", 0.6),
    ("lgpl", 1, " general public", rf"{GNU}(?:lesser|library) general public licen[cs]e", 0.7),
    ("agpl", 1, " general public", rf"{GNU}affero general public licen[cs]e", 0.7),
    ("gpl", 1, " gpl", r"(?:gnu )?gpl", 0.5),
    ("lgpl", 1, " lgpl", r"(?:gnu )?lgpl", 0.5),
    ("agpl", 1, " agpl", r"(?:gnu )?agpl", 0.5),
    ("cc0", 1, " cc0", r"cc0", 0.6),
    ("cc", 1, " creative commons", r"creative commons(?: licen[cs]e)?", 0.5),
    ("public-domain", 1, " public domain", r"public domain", 0.4),
    ("reserved", 1, " reserved", r"(?:all|some|no) rights reserved", 0.5),
    ("copyright", 0, " copyright", r"copyright(?: c)?(?: \d{4})+", 0.3),
    ("copyright", 0, " copyright", r"copyright", 0.2),
    ("license", 0, " licen", r"licen[cs](?:e|es|ed|ing)", 0.2),
]

#: Licenses by name with the versions that exist.
VERSIONED = {
    ("apache", " apache", r"apache (?:software )?(?:foundation )?licen[cs]e"): ["1.0", "1.1", "2.0"],
    ("mpl", " mozilla", r"mozilla public licen[cs]e"): ["1.0", "1.1", "2.0"],
    ("epl", " licen", r"eclipse public licen[cs]e"): ["1.0", "2.0"],
    ("cddl", " licen", r"common development and distribution licen[cs]e"): ["1.0", "1.1"],
    ("eupl", " licen", r"european union public licen[cs]e"): ["1.0", "1.1", "1.2"],
    ("artistic", " licen", r"artistic licen[cs]e"): ["1.0", "2.0"],
    ("afl", " licen", r"academic free licen[cs]e"): ["1.1", "1.2", "2.0", "2.1", "3.0"],
    ("osl", " licen", r"open software licen[cs]e"): ["1.0", "2.0", "2.1", "3.0"],
    ("gfdl", " licen", rf"{GNU}free documentation licen[cs]e"): ["1.1", "1.2", "1.3"],
    ("gpl", " general public", rf"{GNU}general public licen[cs]e"): ["1.0", "2.0", "3.0"],
    ("lgpl", " general public", rf"{GNU}(?:lesser|library) general public licen[cs]e"): ["2.0", "2.1", "3.0"],
    ("agpl", " general public", rf"{GNU}affero general public licen[cs]e"): ["1.0", "3.0"],
    ("gpl", " gpl", r"(?:gnu )?gpl"): ["1.0", "2.0", "3.0"],
    ("lgpl", " lgpl", r"(?:gnu )?lgpl"): ["2.0", "2.1", "3.0"],
    ("agpl", " agpl", r"(?:gnu )?agpl"): ["1.0", "3.0"],
    ("ofl", " licen", r"(?:sil )?open font licen[cs]e"): ["1.0", "1.1"],
    ("php", " licen", r"php licen[cs]e"): ["3.0", "3.01"],
    ("cc0", " cc0", r"cc0"): ["1.0"],
}

CC_PARTS = {"by": "attribution", "sa": "share ?alike", "nc": "non ?commercial", "nd": "no ?deriv(?:ative)?s?(?: works)?"}
CC_KINDS = ["by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd"]
CC_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]

#: Identifiers that stand behind a tag of their own.
IDENTIFIERS = (
    "mit mit-0 isc zlib bsl-1.0 apache-1.0 apache-1.1 apache-2.0 bsd-2-clause bsd-3-clause bsd-4-clause "
    "mpl-1.0 mpl-1.1 mpl-2.0 epl-1.0 epl-2.0 cddl-1.0 cddl-1.1 eupl-1.1 eupl-1.2 artistic-1.0 artistic-2.0 "
    "gpl-1.0-only gpl-1.0-or-later gpl-2.0-only gpl-2.0-or-later gpl-3.0-only gpl-3.0-or-later "
    "lgpl-2.0-only lgpl-2.1-only lgpl-2.1-or-later lgpl-3.0-only lgpl-3.0-or-later agpl-3.0-only agpl-3.0-or-later "
    "ofl-1.1 odbl-1.0 pddl-1.0 cc0-1.0 unlicense wtfpl psf-2.0 ruby openssl ms-pl ms-rl afl-3.0 osl-3.0 "
    "cc-by-3.0 cc-by-4.0 cc-by-sa-3.0 cc-by-sa-4.0 cc-by-nc-4.0 cc-by-nc-sa-4.0 cc-by-nd-4.0 cc-by-nc-nd-4.0"
).split()


def words_of(text: str) -> str:
    return " ".join("".join(c if c.isalnum() else " " for c in text).split())


def rules() -> list[Rule]:
    """All rules, first those that win ties."""
    found = [Rule(*r) for r in GRANTS]
    for name in IDENTIFIERS:
        found.append(Rule(name, 3, " spdx", f"spdx license identifier {words_of(name)}", 0.99))
    for n in (2, 3, 4):
        spelled = {2: "two|simplified", 3: "three|new|revised|modified", 4: "four|original"}[n]
        found.append(Rule(f"bsd-{n}-clause", 2, " bsd", rf"bsd (?:{n}|{spelled})(?: clause)?(?: licen[cs]e)?", 0.85))
        found.append(Rule(f"bsd-{n}-clause", 2, " bsd", rf"(?:the )?(?:{n}|{spelled}) (?:clause )?bsd(?: licen[cs]e)?", 0.85))
    for (label, keyword, name), versions in VERSIONED.items():
        for v in versions:
            major, minor = v.split(".")
            number = rf"{major} {minor}" if minor != "0" else rf"{major}(?: 0)?(?! \d)"
            found.append(Rule(f"{label}-{v}", 2, keyword, rf"{name}{VERSION}{number}", 0.9))
            if "gpl" in label:
                found.append(Rule(f"{label}-{v}-or-later", 2, keyword, rf"{name}{VERSION}{number}{LATER}", 0.92))
    for kind in CC_KINDS:
        parts = kind.split("-")
        short, name = " ".join(parts), " ".join(CC_PARTS[p] for p in parts)
        found.append(Rule(f"cc-{kind}", 1, " cc ", f"cc {short}", 0.6))
        found.append(Rule(f"cc-{kind}", 1, " creative commons", rf"creative commons {name}", 0.7))
        for v in CC_VERSIONS:
            number = words_of(v)
            found.append(Rule(f"cc-{kind}-{v}", 2, " cc ", f"cc {short} {number}", 0.9))
            found.append(Rule(f"cc-{kind}-{v}", 2, " creative commons", rf"creative commons {name} {number}(?: (?:international|unported|generic))?", 0.95))
    found.extend(Rule(*r) for r in NAMES)
    return found
