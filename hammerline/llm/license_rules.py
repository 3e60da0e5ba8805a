"""The signature rules of the license scan, in order of priority.

A pattern is words with blanks between; ``a|b`` are alternatives, ``word?`` may be missing, ``*`` is any word
and ``*?`` any word or none; what follows ``version|v?`` may have the v joined to it.  Each is compiled to a regular expression over words that end with a blank, anchored at its first
word, whose alternatives are the rule's keywords; ``gate`` is a word that must be among the next ones for the expression to
be tried at all, if none is given the longest that the pattern needs.  Sentences and notices are written one by one; names of licenses give four rules each."""

from __future__ import annotations

import re
from typing import NamedTuple

#: Priorities, best first.  Base phrases never suppress and are never suppressed.
NOTICE, TAG, GRANT, NAME, CUE, BASE = range(6)


class Rule(NamedTuple):
    number: int
    keyword: str
    gate: str
    regex: str
    label: str
    priority: int
    weight: float


BASE_PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: (label, pattern, weight): sentences of license texts, notices and statements of rights.
NOTICES = (
    ("apache-2.0", "licensed under the apache license version 2 0? the license you may not use this file except in compliance", 1.0),
    ("apache-2.0", "you may not use this file except in compliance with the license", 0.9),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license", 0.95),
    ("apache-2.0", "you may obtain a copy of the license at http|https www? apache org licenses license 2 0", 1.0),
    ("apache-2.0", "http|https www? apache org licenses license 2 0", 0.95),
    ("apache-1.1", "this product includes software developed by the apache software foundation|group", 0.85),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", 1.0),
    ("mit", "above copyright notice and this permission notice shall be included in all copies", 0.95),
    ("mit", "http|https www? opensource org licenses mit license? php?", 0.95),
    ("isc", "permission to use copy modify and or? distribute this software for any purpose with or without fee is hereby granted", 1.0),
    ("0bsd", "permission to use copy modify and or? distribute this software for any purpose with or without fee is hereby granted the software is provided as is", 1.0),
    ("bsd-2-clause", "redistribution and use in source and binary forms with or without modification are permitted", 0.9),
    ("bsd-3-clause", "neither the names? of the? *? *? *? *? nor the names? of its|any contributors may be used to endorse or promote", 1.0),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display", 1.0),
    ("bsd", "redistributions of source code must retain the above copyright notice", 0.9),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice", 0.9),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", 1.0),
    ("gpl-2.0-or-later", "either version 2 of the license or at your option any later version", 0.95),
    ("gpl-3.0-or-later", "either version 3 of the license or at your option any later version", 0.95),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser|library general public license", 1.0),
    ("gpl", "everyone is permitted to copy and distribute verbatim copies of this license document", 0.9),
    ("gpl", "you should have received a copy of the gnu general public license along with", 0.95),
    ("lgpl", "you should have received a copy of the gnu lesser|library general public license along with", 0.95),
    ("agpl", "you should have received a copy of the gnu affero general public license along with", 0.95),
    ("gpl", "http|https www? gnu org licenses gpl *?", 0.85),
    ("lgpl", "http|https www? gnu org licenses lgpl *?", 0.85),
    ("agpl", "http|https www? gnu org licenses agpl *?", 0.85),
    ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", 1.0),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v|version 2 0?", 1.0),
    ("mpl-2.0", "http|https www? mozilla org mpl 2 0", 0.9),
    ("mpl-1.1", "contents of this file are subject to the mozilla public license version 1 1", 1.0),
    ("epl-2.0", "this program and the accompanying materials are made available under the terms of the eclipse public license v|version? 2 0", 1.0),
    ("epl-1.0", "this program and the accompanying materials are made available under the terms of the eclipse public license v|version? 1 0", 1.0),
    ("cddl-1.0", "contents of this file are subject to the terms of the common development and distribution license", 1.0),
    ("bsl-1.0", "distributed under the boost software license version 1 0", 1.0),
    ("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software", 1.0),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable", 1.0),
    ("zlib", "altered source versions must be plainly marked as such", 0.9),
    ("unlicense", "this is free and unencumbered software released into the public domain", 1.0),
    ("public-domain", "released|placed|dedicated into|in|to the public domain", 0.7),
    ("public-domain", "this work|file|document|text|image is in the public domain", 0.75),
    ("cc0-1.0", "to the extent possible under law *? *? *? *? has|have waived all copyright", 1.0),
    ("wtfpl", "everyone is permitted to copy and distribute verbatim or modified copies of this license document", 0.8),
    ("cc-by-4.0", "http|https www? creativecommons org licenses by 4 0", 1.0),
    ("cc-by-sa-4.0", "http|https www? creativecommons org licenses by sa 4 0", 1.0),
    ("cc-by-nc-4.0", "http|https www? creativecommons org licenses by nc 4 0", 1.0),
    ("cc-by-nd-4.0", "http|https www? creativecommons org licenses by nd 4 0", 1.0),
    ("cc-by-nc-sa-4.0", "http|https www? creativecommons org licenses by nc sa 4 0", 1.0),
    ("cc-by-nc-nd-4.0", "http|https www? creativecommons org licenses by nc nd 4 0", 1.0),
    ("cc", "http|https www? creativecommons org licenses *", 0.8),
    ("cc0-1.0", "http|https www? creativecommons org publicdomain zero 1 0", 1.0),
    ("public-domain", "http|https www? creativecommons org publicdomain mark *?", 0.9),
    ("cc", "some rights reserved", 0.6),
    ("reserved", "no part of this publication|book|work|document|website may be reproduced", 0.9),
    ("reserved", "may not be reproduced distributed? or? transmitted? in any form without", 0.8),
    ("reserved", "unauthorized|unauthorised copying|reproduction|use|distribution of this file|work|material|content is? strictly? prohibited", 0.85),
    ("proprietary", "this software is proprietary and confidential", 0.9),
    ("proprietary", "proprietary and confidential", 0.7),
    ("proprietary", "confidential and proprietary", 0.7),
    ("proprietary", "for internal use only", 0.5),
    ("artistic-2.0", "artistic license 2 0", 0.9),
    ("openssl", "this product includes software developed by the openssl project", 0.95),
    ("php-3.01", "this source file is subject to version 3 01 of the php license", 1.0),
    ("ofl-1.1", "this font software is licensed under the sil open font license version 1 1", 1.0),
    ("eupl-1.2", "licensed under the eupl version|v? 1 2", 1.0),
    ("odbl-1.0", "this database|data is made available under the open database license", 0.95),
    ("ogl-uk-3.0", "contains public sector information licensed under the open government licence v3? 3? 0?", 0.95),
)

#: (label, gate, name): each gives a tag, a grant, a field and a bare form.
LICENSES = (
    ("apache-2.0", "apache", "apache software? license|licence version|v? 2? 0?"), ("apache-2.0", "apache", "apache 2 0"),
    ("apache-1.1", "apache", "apache software? license|licence version|v? 1 1"), ("mit", "mit", "mit|expat|x11 license|licence"),
    ("mit-0", "mit", "mit no attribution license?"), ("isc", "isc", "isc license|licence"), ("0bsd", "bsd", "bsd zero clause license?"),
    ("bsd-2-clause", "bsd", "bsd 2 clause simplified? license?"), ("bsd-3-clause", "bsd", "bsd 3 clause new? or? revised? license?"),
    ("bsd-4-clause", "bsd", "bsd 4 clause original? license?"), ("bsd-2-clause", "bsd", "simplified|freebsd bsd? license|licence"),
    ("bsd-3-clause", "bsd", "new|revised|modified bsd license|licence"), ("bsd", "bsd", "bsd style? license|licence"),
    ("gpl-1.0", "1", "gnu? gpl version|v? 1 0?"), ("gpl-2.0", "2", "gnu general public license|licence version|v? 2 0?"),
    ("gpl-2.0", "gpl", "gpl version|v? 2 0? only?"), ("gpl-2.0-or-later", "later", "gpl version|v? 2 0? or any? later version?"),
    ("gpl-3.0", "3", "gnu general public license|licence version|v? 3 0?"), ("gpl-3.0", "gpl", "gpl version|v? 3 0? only?"),
    ("gpl-3.0-or-later", "later", "gpl version|v? 3 0? or any? later version?"), ("gpl-2.0", "gplv2", "gplv2"), ("gpl-3.0", "gplv3", "gplv3"),
    ("gpl", "general", "gnu general public license|licence"), ("lgpl-2.1", "1", "gnu lesser|library general public license|licence version|v? 2 1"),
    ("lgpl-2.0", "2", "gnu lesser|library general public license|licence version|v? 2 0?"), ("lgpl-3.0", "3", "gnu lesser general public license|licence version|v? 3 0?"),
    ("lgpl-2.1", "lgpl", "lgpl version|v? 2 1"), ("lgpl-3.0", "lgpl", "lgpl version|v? 3 0?"), ("lgpl", "general", "gnu lesser|library general public license|licence"),
    ("agpl-3.0", "affero", "gnu affero general public license|licence version|v? 3 0?"), ("agpl-3.0", "agpl", "agpl version|v? 3 0?"),
    ("agpl", "affero", "gnu? affero general public license|licence"), ("gfdl-1.3", "documentation", "gnu free documentation license|licence version|v? 1 3"),
    ("gfdl", "documentation", "gnu free documentation license|licence"), ("mpl-1.1", "1", "mozilla public license|licence version|v? 1 1"),
    ("mpl-2.0", "2", "mozilla public license|licence version|v? 2 0"), ("mpl-2.0", "mpl", "mpl version|v? 2 0"), ("mpl", "mozilla", "mozilla public license|licence"),
    ("epl-1.0", "1", "eclipse public license|licence version|v? 1 0"), ("epl-2.0", "2", "eclipse public license|licence version|v? 2 0"),
    ("epl", "eclipse", "eclipse public license|licence"), ("cddl-1.0", "cddl", "cddl version|v? 1 0?"), ("cddl", "development", "common development and distribution license"),
    ("cpl-1.0", "common", "common public license version|v? 1? 0?"), ("eupl", "european", "european union public licence|license"),
    ("bsl-1.0", "boost", "boost software license|licence version|v? 1? 0?"), ("zlib", "zlib", "zlib libpng? license|licence"),
    ("artistic-2.0", "2", "artistic license|licence version|v? 2 0?"), ("artistic", "artistic", "artistic license|licence"), ("perl", "perl", "same terms as perl itself"),
    ("psf-2.0", "python", "python software foundation license|licence version|v? 2? 0?"), ("ruby", "ruby", "ruby license|licence"), ("php", "php", "php license|licence version|v? 3? 01?"),
    ("wtfpl", "public", "do what the fuck you want to public license"), ("wtfpl", "wtfpl", "wtfpl"), ("unlicense", "unlicense", "unlicense"),
    ("beerware", "beer", "beer ware|license license?"), ("ms-pl", "microsoft", "microsoft public license|licence"), ("ms-rl", "microsoft", "microsoft reciprocal license|licence"),
    ("ofl-1.1", "font", "sil? open font license|licence version|v? 1? 1?"), ("odbl-1.0", "database", "open database license|licence"), ("odc-by-1.0", "commons", "open data commons attribution license|licence"),
    ("ogl-uk", "government", "open government licence|license"), ("elastic-2.0", "elastic", "elastic license|licence version|v? 2? 0?"), ("sspl-1.0", "server", "server side public license|licence"),
    ("busl-1.1", "business", "business source license|licence version|v? 1? 1?"), ("openrail", "rail", "open|creativeml|bigscience open? rail m? license?"),
    ("llama-community", "llama", "llama 2|3? community license|licence agreement?"), ("cc0-1.0", "cc0", "cc0 1? 0? universal?"),
    ("cc-by-4.0", "4", "cc by 4 0"), ("cc-by-3.0", "3", "cc by 3 0"), ("cc-by-2.0", "2", "cc by 2 0|5"), ("cc-by-sa-4.0", "sa", "cc by sa 4 0"), ("cc-by-sa-3.0", "sa", "cc by sa 3 0"),
    ("cc-by-nd-4.0", "nd", "cc by nd 4 0"), ("cc-by-nc-4.0", "nc", "cc by nc 4 0"), ("cc-by-nc-3.0", "nc", "cc by nc 3 0"), ("cc-by-nc-sa-4.0", "sa", "cc by nc sa 4 0"),
    ("cc-by-nc-sa-3.0", "sa", "cc by nc sa 3 0"), ("cc-by-nc-nd-4.0", "nd", "cc by nc nd 4 0"), ("cc-by-sa", "sa", "cc by sa"), ("cc-by-nd", "nd", "cc by nd"), ("cc-by-nc", "nc", "cc by nc"),
    ("cc-by-nc-sa", "sa", "cc by nc sa"), ("cc-by-nc-nd", "nd", "cc by nc nd"), ("cc-by", "attribution", "creative commons attribution *? *? *? license|licence"),
    ("cc-by-sa", "sharealike", "creative commons attribution sharealike *? *? *? license|licence?"), ("cc-by-nc", "noncommercial", "creative commons attribution noncommercial *? *? *? license|licence?"),
    ("cc", "creative", "creative commons license|licence"), ("public-domain", "domain", "public domain mark|dedication"),
)

#: (priority, weight, words before the name)
FORMS = (
    (TAG, 0.98, "spdx license identifier"),
    (GRANT, 0.95, "licensed|released|distributed|published|available|covered|provided|shared|redistributed under the? terms? of? the? a?"),
    (GRANT, 0.9, "license|licence|licenses is? the?"),
    (NAME, 0.8, ""),
)

#: Weaker words that say something of rights, with no license of their own.
CUES = (
    ("copyright", "copyright c? *? 19*|20* *? *?", 0.4), ("copyright", "copyrighted material|work|content", 0.4), ("license", "see|read the? license|licence file for|in|details", 0.4),
    ("license", "licensed|released|distributed under the? *? *? license|licence", 0.45), ("trademark", "registered trademarks? of", 0.3), ("trademark", "trademarks? of their respective owners", 0.4),
    ("warranty", "without warranty|warranties of any kind", 0.4), ("warranty", "as is without warranty|warranties", 0.4), ("eula", "end user license|licence agreement", 0.6), ("terms", "terms of use|service apply|prohibit", 0.3),
)


def compiled(pattern: str) -> str:
    """The regular expression of a pattern: each word with the blank behind it."""
    out, before = "", ""
    for token in pattern.split():
        optional = token.endswith("?")
        words = token.rstrip("?").split("|")
        if before == "version|v?":
            words += ["v" + w for w in words]
        before = token
        body = "|".join("[^ ]+" if w == "*" else re.escape(w).replace(r"\*", "[0-9]+") for w in words)
        out += f"(?:(?:{body}) )" + ("?" if optional else "")
    return f"^{out}"


def longest(rules: list[Rule]) -> int:
    return max(r.regex.count(" )") for r in rules)


def build_rules() -> list[Rule]:
    """All rules in order; one with several first words is listed under each."""
    found = [(label, pattern, BASE, 0.5, "") for pattern, label in BASE_PHRASES]
    found += [(label, pattern, NOTICE, weight, "") for label, pattern, weight in NOTICES]
    for priority, weight, before in FORMS:
        found += [(label, f"{before} {name}".strip(), priority, weight, gate) for label, gate, name in LICENSES]
    found += [(label, pattern, CUE, weight, "") for label, pattern, weight in CUES]
    rules = []
    for number, (label, pattern, priority, weight, gate) in enumerate(found):
        first, *rest = pattern.split()
        if first.endswith("?"):  # with its optional first word and without
            starts = [(k, rest) for k in first[:-1].split("|")] + [(k, rest[1:]) for k in rest[0].split("|")]
        else:
            starts = [(k, rest) for k in first.split("|")]
        for keyword, others in starts:
            needed = [w for w in others if w.isalnum()]
            own_gate = gate or max(needed, key=len, default="")
            rules.append(Rule(number, keyword, own_gate, compiled(" ".join([keyword, *others])), label, priority, weight))
    return rules
