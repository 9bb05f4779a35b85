"""Signatures of licenses: label, keyword, regular expression, priority (lower wins), confidence in percent.

Texts are in lower case when a rule or a keyword sees them, and what matches ``GAP`` is one space in them. A rule is
tried only where its keyword stands, so the keyword must be part of every text that the expression can match.
"""

from __future__ import annotations

_SPACE = " \\t-\\r\\x85\\xa0\\u2000-\\u200b\\u2028\\u2029\\u202f\\u3000"
_SIGNS = f"[{_SPACE}*#/;%!|>]*+"
#: White space between words with the comment signs of wrapped lines: closing signs, an opening sign, or -- and quotes that
#: stand alone. Possessive, and not begun inside a run of signs, so long runs take time in proportion and no stack.
GAP = rf"(?<![*#/])[*#/]*+[{_SPACE}]{_SIGNS}(?:[\"'-]++[{_SPACE}]{_SIGNS})*+"

#: Families: label pattern, keyword, names (how texts call it), versions.
_VERSIONED = [
    ("gpl-{}", "gpl", ("gpl", "gnu gpl", "the gpl"), ("1.0", "2.0", "3.0")),
    ("gpl-{}", "general public license", ("gnu general public license", "general public license"), ("1.0", "2.0", "3.0")),
    ("lgpl-{}", "lgpl", ("lgpl", "gnu lgpl"), ("2.0", "2.1", "3.0")),
    ("lgpl-{}", "lesser general public license", ("gnu lesser general public license", "lesser general public license"), ("2.1", "3.0")),
    ("lgpl-{}", "library general public license", ("gnu library general public license", "library general public license"), ("2.0", "2.1")),
    ("agpl-{}", "agpl", ("agpl", "gnu agpl"), ("1.0", "3.0")),
    ("agpl-{}", "affero general public license", ("gnu affero general public license", "affero general public license"), ("1.0", "3.0")),
    ("gfdl-{}", "free documentation license", ("gnu free documentation license", "free documentation license"), ("1.1", "1.2", "1.3")),
    ("apache-{}", "apache", ("apache license", "apache software license", "apache public license"), ("1.0", "1.1", "2.0")),
    ("mpl-{}", "mozilla public license", ("mozilla public license",), ("1.0", "1.1", "2.0")),
    ("mpl-{}", "mpl", ("mpl",), ("1.0", "1.1", "2.0")),
    ("epl-{}", "eclipse public license", ("eclipse public license",), ("1.0", "2.0")),
    ("cddl-{}", "common development and distribution license", ("common development and distribution license",), ("1.0", "1.1")),
    ("cpl-{}", "common public license", ("common public license",), ("1.0",)),
    ("eupl-{}", "european union public licence", ("european union public licence",), ("1.0", "1.1", "1.2")),
    ("artistic-{}", "artistic license", ("artistic license", "perl artistic license"), ("1.0", "2.0")),
    ("osl-{}", "open software license", ("open software license",), ("1.0", "2.0", "2.1", "3.0")),
    ("afl-{}", "academic free license", ("academic free license",), ("1.1", "1.2", "2.0", "2.1", "3.0")),
    ("ofl-{}", "open font license", ("sil open font license", "open font license"), ("1.0", "1.1")),
    ("lppl-{}", "project public license", ("latex project public license",), ("1.0", "1.1", "1.2", "1.3")),
    ("cecill-{}", "cecill", ("cecill", "cecill license", "cecill-b", "cecill-c"), ("1.0", "1.1", "2.0", "2.1")),
    ("qpl-{}", "q public license", ("q public license",), ("1.0",)),
    ("apsl-{}", "apple public source license", ("apple public source license",), ("1.0", "1.1", "1.2", "2.0")),
    ("npl-{}", "netscape public license", ("netscape public license",), ("1.0", "1.1")),
    ("ms-pl-{}", "microsoft public license", ("microsoft public license",), ("1.0",)),
    ("zpl-{}", "zope public license", ("zope public license",), ("1.1", "2.0", "2.1")),
    ("php-{}", "php license", ("php license",), ("3.0", "3.01")),
    ("ecl-{}", "educational community license", ("educational community license",), ("1.0", "2.0")),
    ("upl-{}", "universal permissive license", ("universal permissive license",), ("1.0",)),
    ("odbl-{}", "open database license", ("open database license",), ("1.0",)),
    ("bsl-{}", "boost software license", ("boost software license",), ("1.0",)),
    ("busl-{}", "business source license", ("business source license",), ("1.0", "1.1")),
    ("elastic-{}", "elastic license", ("elastic license",), ("1.0", "2.0")),
    ("sspl-{}", "server side public license", ("server side public license",), ("1.0",)),
    ("ncsa-{}", "open source license", ("university of illinois/ncsa open source license",), ("1.0",)),
]
_CC_KINDS = {"by": "attribution", "by-sa": "attribution{}share{}alike", "by-nd": "attribution{}no{}derivatives", "by-nc": "attribution{}non{}commercial", "by-nc-sa": "attribution{}non{}commercial{}share{}alike", "by-nc-nd": "attribution{}non{}commercial{}no{}derivatives"}
_CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
_SPDX = (
    "mit mit-0 0bsd isc apache-1.1 apache-2.0 bsd-1-clause bsd-2-clause bsd-3-clause bsd-4-clause gpl-1.0 gpl-2.0 gpl-3.0 lgpl-2.0 lgpl-2.1 lgpl-3.0 agpl-3.0 mpl-1.1 mpl-2.0 "
    "epl-1.0 epl-2.0 cddl-1.0 cc0-1.0 unlicense wtfpl zlib bsl-1.0 artistic-2.0 ofl-1.1 python-2.0 postgresql ncsa eupl-1.2 osl-3.0 afl-3.0 upl-1.0 ms-pl ms-rl x11 vim openssl curl"
).split()
#: Names and passages: label, keyword, expression, priority, confidence.
_PHRASES = [
    ("mit", "mit license", r"\bmit license\b", 30, 90),
    ("mit", "the mit", r"\b(?:released|licensed|distributed|available|provided) under (?:the terms of )?the mit\b(?: license)?", 20, 95),
    ("mit", "expat license", r"\bexpat license\b", 30, 90),
    ("mit", "permission is hereby granted, free of charge", r"permission is hereby granted, free of charge, to any person obtaining a copy", 10, 99),
    ("mit-0", "mit no attribution", r"\bmit no attribution\b", 10, 95),
    ("x11", "x11 license", r"\bx11 license\b", 30, 90),
    ("apache", "apache license", r"\bapache license\b", 40, 85),
    ("apache-2.0", "apache.org/licenses", r"apache\.org/licenses/license-2\.0", 10, 99),
    ("apache-2.0", "apache", r"\blicensed under the apache license,? version 2\.0\b", 5, 99),
    ("gpl", "general public license", r"\bgeneral public license\b", 50, 80),
    ("gpl", "gnu gpl", r"\bgnu gpl\b", 50, 80),
    ("gpl-2.0-or-later", "either version 2", r"either version 2 of the license, or \(at your option\) any later version", 10, 99),
    ("gpl-3.0-or-later", "either version 3", r"either version 3 of the license, or \(at your option\) any later version", 10, 99),
    ("gpl-3.0", "general public license", r"\bgnu general public license,? version 3\b", 5, 97),
    ("gpl-2.0", "general public license", r"\bgnu general public license,? version 2\b", 5, 97),
    ("lgpl", "lesser general public license", r"\blesser general public license\b", 45, 85),
    ("agpl", "affero general public license", r"\baffero general public license\b", 45, 85),
    ("bsd", "bsd license", r"\bbsd license\b", 50, 80),
    ("bsd-2-clause", "bsd", r"\b(?:simplified|freebsd|2[- ]clause) bsd\b", 20, 90),
    ("bsd-2-clause", "bsd", r"\bbsd[- ]2[- ]clause\b", 20, 95),
    ("bsd-3-clause", "bsd", r"\b(?:new|revised|modified|3[- ]clause) bsd\b", 20, 90),
    ("bsd-3-clause", "bsd", r"\bbsd[- ]3[- ]clause\b", 20, 95),
    ("bsd-4-clause", "bsd", r"\b(?:original|4[- ]clause) bsd\b", 20, 90),
    ("bsd", "redistribution and use in source and binary forms", r"redistribution and use in source and binary forms, with or without modification", 15, 95),
    ("bsd-3-clause", "neither the name", r"neither the name of .{1,80}? nor the names of (?:its|any) contributors", 12, 95),
    ("bsd-4-clause", "advertising materials", r"all advertising materials mentioning features or use of this software", 11, 95),
    ("isc", "isc license", r"\bisc license\b", 30, 90),
    ("isc", "permission to use, copy, modify", r"permission to use, copy, modify, and/or distribute this software for any purpose", 10, 98),
    ("zlib", "zlib license", r"\bzlib license\b", 30, 90),
    ("zlib", "as-is", r"this software is provided 'as-is', without any express or implied warranty", 12, 95),
    ("unlicense", "unlicense", r"\bunlicense(?:\.org|d into the public domain)?\b", 25, 85),
    ("unlicense", "public domain", r"this is free and unencumbered software released into the public domain", 5, 99),
    ("wtfpl", "wtfpl", r"\bwtfpl\b", 25, 90),
    ("wtfpl", "what the fuck you want", r"do what the fuck you want to public license", 5, 99),
    ("cc0-1.0", "cc0", r"\bcc0(?: 1\.0)?(?: universal)?\b", 25, 90),
    ("cc0-1.0", "publicdomain/zero", r"creativecommons\.org/publicdomain/zero/1\.0", 5, 99),
    ("public-domain", "public domain", r"\b(?:released|dedicated|placed|put) (?:in)?to the public domain\b", 30, 80),
    ("public-domain", "public domain", r"\bin the public domain\b", 40, 60),
    ("cc", "creative commons", r"\bcreative commons(?: license| licence)?\b", 60, 60),
    ("boost", "boost software license", r"\bboost software license\b", 40, 85),
    ("artistic", "artistic license", r"\bartistic license\b", 50, 80),
    ("mpl", "mozilla public license", r"\bmozilla public license\b", 45, 85),
    ("epl", "eclipse public license", r"\beclipse public license\b", 45, 85),
    ("cddl", "common development and distribution license", r"\bcommon development and distribution license\b", 45, 85),
    ("ofl", "open font license", r"\bopen font license\b", 45, 85),
    ("eupl", "european union public licence", r"\beuropean union public licence\b", 45, 85),
    ("osl", "open software license", r"\bopen software license\b", 45, 80),
    ("python", "python software foundation license", r"\bpython software foundation license(?: version 2)?\b", 30, 90),
    ("postgresql", "postgresql licen", r"\bpostgresql licen[sc]e\b", 30, 90),
    ("openssl", "openssl license", r"\bopenssl license\b", 30, 90),
    ("vim", "vim license", r"\bvim license\b", 30, 90),
    ("ruby", "ruby license", r"\bruby license\b", 30, 85),
    ("beerware", "beer-ware license", r"\bbeer-ware license\b", 30, 90),
    ("json", "not evil", r"shall be used for good, not evil", 10, 95),
    ("ms-pl", "microsoft public license", r"\bmicrosoft public license\b", 45, 85),
    ("ms-rl", "microsoft reciprocal license", r"\bmicrosoft reciprocal license\b", 45, 85),
    ("commons-clause", "commons clause", r"\bcommons clause\b", 30, 85),
    ("odc-by", "open data commons attribution", r"\bopen data commons attribution license\b", 30, 90),
    ("odbl", "open database license", r"\bopen database license\b", 45, 85),
    ("pddl", "public domain dedication and license", r"\bpublic domain dedication and license\b", 20, 90),
    ("proprietary", "all rights reserved", r"\ball rights reserved\b", 70, 50),
    ("proprietary", "confidential", r"\b(?:proprietary and confidential|confidential and proprietary)\b", 60, 60),
    ("proprietary", "unauthori", r"\bunauthori[sz]ed (?:copying|use|reproduction|distribution) (?:of .{1,60}? )?is (?:strictly )?prohibited\b", 50, 70),
    ("copyright", "copyright", r"\bcopyright(?: \(c\)| ©)? (?:19|20)[0-9]{2}\b", 80, 30),
    ("no-derivatives", "noderiv", r"\bnoderivs?(?:atives)?\b", 80, 40),
    ("no-derivatives", "no-deriv", r"\bno-derivs?(?:atives)?\b", 80, 40),
    ("non-commercial", "commercial use", r"\b(?:non-?commercial use only|not for commercial use|no commercial use)\b", 70, 50),
    ("mit", "and this permission notice", r"the above copyright notice and this permission notice(?: \(including the next paragraph\))? shall be included in all copies or substantial portions of the software", 10, 97),
    ("mit", "to deal in the software without restriction", r"permission to deal in the software without restriction", 14, 85),
    ("mit-modern", "permission is hereby granted, without written agreement", r"permission is hereby granted, without written agreement and without license or royalty fees", 9, 96),
    ("mit-advertising", "permission is hereby granted", r"permission is hereby granted for the advertising of this software", 9, 90),
    ("x11", "not be used in advertising", r"shall not be used in advertising or otherwise to promote the sale, use or other dealings", 9, 95),
    ("apache-2.0", "except in compliance with the license", r"you may not use this (?:file|work|software) except in compliance with the license", 8, 97),
    ("apache-2.0", "distributed under the license is distributed", r"unless required by applicable law or agreed to in writing, software distributed under the license is distributed on an \"?as is\"? basis", 8, 97),
    ("apache-2.0", "apache license", r"\bapache license,? version 2\.0, january 2004\b", 4, 99),
    ("apache-1.1", "apache software foundation", r"this product includes software developed by the apache software foundation", 10, 90),
    ("apache-1.1", "apache", r"the names \"?apache server\"? and \"?apache group\"? must not be used to endorse", 8, 92),
    ("gpl", "gnu general public license", r"terms of the gnu general public license as published by the free software foundation", 12, 93),
    ("gpl", "general public license", r"you should have received a copy of the gnu general public license along with", 12, 93),
    ("gpl-2.0", "general public license", r"\bgeneral public license version 2, june 1991\b", 4, 99),
    ("gpl-3.0", "general public license", r"\bgeneral public license version 3, 29 june 2007\b", 4, 99),
    ("gpl-2.0-only", "version 2 of the license only", r"under the terms of version 2 of the license only\b", 4, 97),
    ("gpl-2.0-only", "general public license", r"gnu general public license,? version 2 only\b", 4, 97),
    ("gpl-2.0-with-classpath-exception", "classpath exception", r"\b(?:gpl|general public license)[^.]{0,60}? with (?:the )?classpath exception", 3, 98),
    ("gpl-with-linking-exception", "linking this library", r"linking this library (?:statically or dynamically )?with other modules is making a combined work", 3, 96),
    ("lgpl", "lesser general public license", r"terms of the gnu lesser general public license as published by the free software foundation", 11, 94),
    ("lgpl", "library general public license", r"terms of the gnu library general public license as published by the free software foundation", 11, 94),
    ("lgpl-2.1", "lesser general public license", r"\blesser general public license version 2\.1, february 1999\b", 3, 99),
    ("agpl", "affero general public license", r"terms of the gnu affero general public license as published by the free software foundation", 11, 94),
    ("agpl-3.0", "affero general public license", r"\baffero general public license version 3, 19 november 2007\b", 3, 99),
    ("gfdl", "free documentation license", r"permission is granted to copy, distribute and/or modify this document under the terms of the gnu free documentation license", 6, 97),
    ("bsd", "redistributions of source code must retain", r"redistributions of source code must retain the above copyright notice, this list of conditions", 14, 95),
    ("bsd", "redistributions in binary form must reproduce", r"redistributions in binary form must reproduce the above copyright notice, this list of conditions", 14, 95),
    ("bsd-3-clause", "endorse or promote products", r"may be used to endorse or promote products derived from this software without specific prior written permission", 13, 93),
    ("bsd-4-clause", "must display the following acknowledg", r"this software must display the following acknowledge?ment", 11, 93),
    ("bsd-2-clause-patent", "bsd-2-clause-patent", r"\bbsd-2-clause-patent\b", 6, 96),
    ("bsd-3-clause-clear", "no express or implied licenses to any party", r"no express or implied licenses to any party's patent rights are granted", 8, 96),
    ("bsd-source-code", "bsd source code attribution", r"\bbsd source code attribution\b", 8, 90),
    ("0bsd", "permission to use", r"permission to use, copy, modify,? (?:and/or )?distribute this software for any purpose with or without fee is hereby granted\.", 8, 96),
    ("isc", "provided that the above copyright notice and this permission notice appear in all copies", r"provided that the above copyright notice and this permission notice appear in all copies", 9, 96),
    ("hpnd", "permission to use, copy, modify", r"permission to use, copy, modify,? and distribute this software and its documentation for any purpose", 9, 92),
    ("ntp", "permission to use, copy, modify", r"permission to use, copy, modify,? and distribute this software for any purpose and without fee is hereby granted", 9, 92),
    ("zlib", "altered source versions", r"altered source versions must be plainly marked as such, and must not be misrepresented as being the original software", 10, 96),
    ("zlib", "the origin of this software must not be misrepresented", r"the origin of this software must not be misrepresented; you must not claim that you wrote the original software", 10, 96),
    ("libpng", "libpng license", r"\blibpng license\b", 20, 90),
    ("libpng", "contributing authors", r"the contributing authors and group 42, inc\. disclaim all warranties", 8, 95),
    ("bsl-1.0", "boost software license", r"\bboost software license - version 1\.0 - august 17th, 2003\b", 3, 99),
    ("bsl-1.0", "boost.org/license_1_0", r"boost\.org/license_1_0\.txt", 6, 97),
    ("unlicense", "unlicense.org", r"\bunlicense\.org\b", 12, 95),
    ("unlicense", "anyone is free to copy", r"anyone is free to copy, modify, publish, use, compile, sell, or distribute this software", 8, 96),
    ("wtfpl", "wtfpl.net", r"\bwtfpl\.net\b", 12, 95),
    ("mpl-2.0", "mozilla public license", r"subject to the terms of the mozilla public license, v\. 2\.0", 3, 99),
    ("mpl-2.0", "mozilla.org/mpl/2.0", r"mozilla\.org/mpl/2\.0", 6, 98),
    ("mpl-1.1", "mozilla public license", r"the contents of this file are subject to the mozilla public license version 1\.1", 3, 99),
    ("epl-2.0", "eclipse public license", r"made available under the terms of the eclipse public license 2\.0", 3, 98),
    ("epl-1.0", "eclipse public license", r"made available under the terms of the eclipse public license v1\.0", 3, 98),
    ("cddl", "common development and distribution license", r"the contents of this file are subject to the terms of the common development and distribution license", 8, 95),
    ("cpl-1.0", "common public license", r"under the terms of the common public license v1\.0", 5, 97),
    ("ipl-1.0", "ibm public license", r"\bibm public license(?: version 1\.0)?\b", 20, 92),
    ("sun-bcl", "binary code license agreement", r"\bbinary code license agreement\b", 25, 85),
    ("artistic-2.0", "artistic license", r"\bthe artistic license 2\.0\b", 6, 97),
    ("perl", "same terms as perl itself", r"under the same terms as perl itself", 10, 93),
    ("ruby", "same terms as ruby", r"under the same terms as ruby\b", 12, 88),
    ("python-2.0", "psf license agreement", r"\bpsf license agreement for python\b", 8, 96),
    ("cnri-python", "cnri open source license agreement", r"\bcnri open source license agreement\b", 8, 95),
    ("openssl", "openssl toolkit", r"this product includes software developed by the openssl project for use in the openssl toolkit", 8, 96),
    ("ssleay", "cryptographic software written by eric young", r"includes cryptographic software written by eric young", 8, 95),
    ("icu", "icu license", r"\bicu license(?: - icu 1\.8\.1 and later)?\b", 20, 92),
    ("unicode", "license agreement", r"\bunicode,? (?:inc\. )?license agreement\b", 10, 94),
    ("w3c", "w3c software notice and license", r"\bw3c software notice and license\b", 10, 95),
    ("curl", "curl license", r"\bcurl license\b", 25, 85),
    ("ftl", "freetype project license", r"\bfreetype project license\b", 15, 94),
    ("ijg", "independent jpeg group", r"this software is based in part on the work of the independent jpeg group", 10, 95),
    ("bzip2", "bzip2 license", r"\bbzip2 license\b", 20, 88),
    ("imagemagick", "imagemagick license", r"\bimagemagick license\b", 20, 90),
    ("tcl", "tcl/tk license", r"\btcl/tk license\b", 20, 90),
    ("sleepycat", "sleepycat license", r"\b(?:the )?sleepycat license\b", 20, 92),
    ("ofl-1.1", "open font license", r"\bsil open font license version 1\.1 - 26 february 2007\b", 3, 99),
    ("ubuntu-font", "ubuntu font licence", r"\bubuntu font licence(?: version 1\.0)?\b", 10, 95),
    ("cc0-1.0", "waived all copyright", r"has waived all copyright and related or neighboring rights", 8, 96),
    ("cc-by-nc", "creative commons", r"creative commons[^.]{0,80}? for non-commercial purposes", 20, 80),
    ("odc-by", "opendatacommons.org/licenses/by", r"opendatacommons\.org/licenses/by", 8, 96),
    ("odbl", "opendatacommons.org/licenses/odbl", r"opendatacommons\.org/licenses/odbl", 8, 96),
    ("pddl", "opendatacommons.org/licenses/pddl", r"opendatacommons\.org/licenses/pddl", 8, 96),
    ("cdla-permissive", "community data license agreement", r"community data license agreement [-–] permissive", 8, 96),
    ("cdla-sharing", "community data license agreement", r"community data license agreement [-–] sharing", 8, 96),
    ("etalab-2.0", "licence ouverte", r"\blicence ouverte(?: / open licence)?(?: version 2\.0)?", 12, 92),
    ("ogl-uk", "open government licence", r"\bopen government licence(?: v[123]\.0)?", 12, 93),
    ("openrail", "openrail", r"\b(?:creativeml |bigscience )?openrail(?:-m|\+\+-m)? license\b", 12, 93),
    ("polyform", "polyform", r"\bpolyform (?:noncommercial|perimeter|shield|small business|strict|internal use) license\b", 8, 95),
    ("hippocratic", "hippocratic license", r"\bhippocratic license\b", 12, 93),
    ("blueoak-1.0.0", "blue oak model license", r"\bblue oak model license\b", 12, 94),
    ("parity", "parity public license", r"\bparity public license\b", 12, 93),
    ("mulan-psl", "mulan permissive software license", r"\bmulan permissive software license\b", 12, 94),
    ("eula", "user licen", r"\bend[- ]user licen[sc]e agreement\b", 40, 75),
    ("shareware", "shareware licen", r"\bshareware licen[sc]e\b", 40, 70),
    ("free-for-personal-use", "for personal use only", r"\blicen[sc]ed? for personal use only\b", 40, 70),
    ("proprietary", "trade secret", r"(?:contains|constitutes) (?:confidential|proprietary|trade secret) information and trade secrets? of", 45, 70),
    ("proprietary", "written permission", r"may not be (?:copied or )?reproduced,? (?:distributed,? )?(?:or transmitted )?in any form (?:or by any means )?without (?:the )?(?:prior )?written permission", 45, 75),
]


def _version(v: str) -> str:
    """An expression for version 2.0, 2, v2 and so on."""
    major, _, minor = v.partition(".")
    return rf"(?:version |v\.? ?|ver\. ?)?{major}" + (r"(?:\.0)?" if minor == "0" else rf"\.{minor}") + r"(?![.0-9]*[0-9])"


def rules() -> list[tuple[str, str, str, int, int]]:
    out = list(_PHRASES)
    for label, keyword, names, versions in _VERSIONED:
        for v in versions:
            name = "|".join(sorted({n for n in names}, key=len, reverse=True)).replace("/ncsa", "(?:/ncsa)?")
            out.append((label.format(v), keyword, rf"\b(?:{name})(?: licen[sc]e)?[,( -]*{_version(v)}", 8, 96))
            out.append((label.format(v) + "-or-later", keyword, rf"\b(?:{name})(?: licen[sc]e)?[,( -]*{_version(v)}\)?,? (?:or (?:\(at your option\) )?(?:any )?(?:later|newer)|\+)", 4, 97))
    for kind, words in _CC_KINDS.items():
        spoken = words.format(*["[- ]?"] * words.count("{}")).replace("attribution[- ]?", "attribution[- ]+")
        for v in _CC_VERSIONS:
            number = v.replace(".", r"\.")
            for gap in " -":
                out.append((f"cc-{kind}-{v}", f"cc{gap}{kind}", rf"\bcc{gap}{kind}[- ]{number}\b", 8, 96))
            out.append((f"cc-{kind}-{v}", "creative commons", rf"\bcreative commons {spoken} {number}\b", 6, 98))
            out.append((f"cc-{kind}-{v}", "creativecommons.org", rf"creativecommons\.org/licenses/{kind}/{number}", 3, 99))
    for name in _SPDX:
        escaped = name.replace(".", r"\.")
        out.append((name, "spdx-license-identifier", rf"spdx-license-identifier:\s*{escaped}(?:-only)?(?![-.a-z0-9])", 1, 100))
        if "gpl" in name:
            out.append((name + "-or-later", "spdx-license-identifier", rf"spdx-license-identifier:\s*{escaped}(?:-or-later|\+)", 1, 100))
    return out
