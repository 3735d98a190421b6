"""The license signatures, in order of priority.

A pattern is a line of words. A word is a regular expression for one whole word;
``~`` before it makes it optional, ``*3`` stands for up to three words of any
kind. The first word is never optional. Patterns are matched against the words of a text,
lower-cased, so punctuation, line breaks and comment signs do not matter.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

#: Classes of rules by priority, and how sure a detection of each makes us of a license.
BASE, TAG, NOTICE, NAME, CLUE = range(5)
CERTAINTY = (1.0, 1.0, 0.9, 0.7, 0.4)

#: The phrases that always count, with their labels.
PHRASES = [("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc")]

#: Label; identifier in license tags, as words; the license's name in running text.
LICENSES = [
    ("mit", "mit", "mit licen[cs]e"),
    ("mit", "expat", "expat licen[cs]e"),
    ("mit-0", "mit 0", "mit no attribution ~licen[cs]e"),
    ("x11", "x11", "x11 licen[cs]e"),
    ("isc", "isc", "isc licen[cs]e"),
    ("0bsd", "0bsd", "zero clause bsd ~licen[cs]e"),
    ("bsd", "bsd", "bsd ~style licen[cs]e"),
    ("bsd-2", "bsd 2 clause", "simplified|2|two ~clause bsd ~licen[cs]e"),
    ("bsd-2", "freebsd", "freebsd licen[cs]e"),
    ("bsd-3", "bsd 3 clause", "new|revised|modified|3|three ~clause bsd ~licen[cs]e"),
    ("bsd-4", "bsd 4 clause", "original|4|four ~clause bsd ~licen[cs]e"),
    ("apache-2", "apache 2 0", "apache ~software ~public licen[cs]e ~version|v|ver 2|v2 ~0"),
    ("apache-1.1", "apache 1 1", "apache ~software licen[cs]e ~version|v 1|v1 1"),
    ("apache-1", "apache 1 0", "apache ~software licen[cs]e ~version|v 1|v1 0"),
    ("apache", "apache", "apache ~software licen[cs]e"),
    ("gpl-1", "gpl 1 0 ~only|or ~later", "gnu general public licen[cs]e ~gpl ~version|v 1|v1"),
    ("gpl-2", "gpl 2 0 ~only|or ~later", "gnu general public licen[cs]e ~gpl ~version|v 2|v2"),
    ("gpl-3", "gpl 3 0 ~only|or ~later", "gnu general public licen[cs]e ~gpl ~version|v 3|v3"),
    ("gpl-2", "gpl 2", "gpl ~version|v 2|v2"),
    ("gpl-3", "gpl 3", "gpl ~version|v 3|v3"),
    ("gpl-2", "gplv2", "gplv2"),
    ("gpl-3", "gplv3", "gplv3"),
    ("gpl", "gpl", "gnu general public licen[cs]e"),
    ("lgpl-2", "lgpl 2 0 ~only|or ~later", "gnu library general public licen[cs]e ~version|v 2|v2"),
    ("lgpl-2.1", "lgpl 2 1 ~only|or ~later", "gnu lesser general public licen[cs]e ~version|v 2|v2 1"),
    ("lgpl-3", "lgpl 3 0 ~only|or ~later", "gnu lesser general public licen[cs]e ~version|v 3|v3"),
    ("lgpl", "lgpl", "gnu lesser|library general public licen[cs]e"),
    ("lgpl-3", "lgplv3", "lgplv3"),
    ("lgpl-2.1", "lgplv2", "lgplv2 ~1"),
    ("agpl-1", "agpl 1 0", "affero general public licen[cs]e ~version|v 1|v1"),
    ("agpl-3", "agpl 3 0 ~only|or ~later", "affero general public licen[cs]e ~version|v 3|v3"),
    ("agpl-3", "agplv3", "agplv3"),
    ("agpl", "agpl", "affero general public licen[cs]e"),
    ("gfdl-1.1", "gfdl 1 1", "gnu free documentation licen[cs]e ~version|v 1|v1 1"),
    ("gfdl-1.2", "gfdl 1 2", "gnu free documentation licen[cs]e ~version|v 1|v1 2"),
    ("gfdl-1.3", "gfdl 1 3", "gnu free documentation licen[cs]e ~version|v 1|v1 3"),
    ("gfdl", "gfdl", "gnu free documentation licen[cs]e"),
    ("mpl-1.0", "mpl 1 0", "mozilla public licen[cs]e ~version|v 1|v1 0"),
    ("mpl-1.1", "mpl 1 1", "mozilla public licen[cs]e ~version|v 1|v1 1"),
    ("mpl-2", "mpl 2 0", "mozilla public licen[cs]e ~version|v 2|v2 ~0"),
    ("mpl", "mpl", "mozilla public licen[cs]e"),
    ("epl-1", "epl 1 0", "eclipse public licen[cs]e ~version|v 1|v1 ~0"),
    ("epl-2", "epl 2 0", "eclipse public licen[cs]e ~version|v 2|v2 ~0"),
    ("epl", "epl", "eclipse public licen[cs]e"),
    ("edl", "edl 1 0", "eclipse distribution licen[cs]e ~version|v ~1|v1 ~0"),
    ("cddl-1", "cddl 1 0", "common development and distribution licen[cs]e ~version|v ~1|v1 ~0"),
    ("cddl-1.1", "cddl 1 1", "common development and distribution licen[cs]e ~version|v 1|v1 1"),
    ("cpl-1", "cpl 1 0", "common public licen[cs]e ~version|v ~1|v1 ~0"),
    ("cpal-1", "cpal 1 0", "common public attribution licen[cs]e ~version|v ~1|v1 ~0"),
    ("ipl-1", "ipl 1 0", "ibm public licen[cs]e ~version|v ~1|v1 ~0"),
    ("eupl-1.1", "eupl 1 1", "european union public licen[cs]e ~version|v 1|v1 1"),
    ("eupl-1.2", "eupl 1 2", "european union public licen[cs]e ~version|v 1|v1 2"),
    ("eupl", "eupl", "european union public licen[cs]e"),
    ("cecill-2.1", "cecill 2 1", "cecill ~free ~software ~licen[cs]e ~agreement ~version|v 2|v2 1"),
    ("cecill", "cecill", "cecill ~free ~software licen[cs]e"),
    ("artistic-1", "artistic 1 0", "artistic licen[cs]e ~version|v 1|v1 ~0"),
    ("artistic-2", "artistic 2 0", "artistic licen[cs]e ~version|v 2|v2 ~0"),
    ("artistic", "artistic", "artistic licen[cs]e"),
    ("bsl-1", "bsl 1 0", "boost software licen[cs]e ~version|v ~1|v1 ~0"),
    ("busl-1.1", "busl 1 1", "business source licen[cs]e ~version|v ~1|v1 ~1"),
    ("zlib", "zlib", "zlib ~libpng licen[cs]e"),
    ("libpng", "libpng", "libpng licen[cs]e"),
    ("openssl", "openssl", "openssl licen[cs]e"),
    ("ssleay", "ssleay", "ssleay licen[cs]e"),
    ("php-3", "php 3 01", "php licen[cs]e ~version|v 3|v3 ~0|01"),
    ("php", "php", "php licen[cs]e"),
    ("python-2", "python 2 0", "python ~software ~foundation licen[cs]e ~agreement ~version ~2"),
    ("psf-2", "psf 2 0", "psf licen[cs]e ~agreement ~version ~2"),
    ("ruby", "ruby", "ruby licen[cs]e"),
    ("postgresql", "postgresql", "postgresql licen[cs]e"),
    ("vim", "vim", "vim licen[cs]e"),
    ("w3c", "w3c", "w3c ~software ~notice ~and licen[cs]e"),
    ("ofl-1.1", "ofl 1 1", "sil open font licen[cs]e ~version|v ~1|v1 ~1"),
    ("ofl", "ofl", "open font licen[cs]e"),
    ("ms-pl", "ms pl", "microsoft public licen[cs]e"),
    ("ms-rl", "ms rl", "microsoft reciprocal licen[cs]e"),
    ("ncsa", "ncsa", "university of illinois ncsa open source licen[cs]e"),
    ("ncsa", "ncsa", "ncsa open source licen[cs]e"),
    ("osl-3", "osl 3 0", "open software licen[cs]e ~version|v ~3|v3 ~0"),
    ("afl-3", "afl 3 0", "academic free licen[cs]e ~version|v ~3|v3 ~0"),
    ("qpl-1", "qpl 1 0", "q public licen[cs]e ~version|v ~1|v1 ~0"),
    ("unicode", "unicode ~dfs ~2016", "unicode licen[cs]e ~agreement"),
    ("upl-1", "upl 1 0", "universal permissive licen[cs]e ~version|v ~1|v1 ~0"),
    ("wtfpl", "wtfpl", "do what the fuck you want to public licen[cs]e"),
    ("unlicense", "unlicense", "the unlicense"),
    ("beerware", "beerware", "beer ware licen[cs]e"),
    ("odbl-1", "odbl 1 0", "open database licen[cs]e ~version|v ~1|v1 ~0"),
    ("odc-by-1", "odc by 1 0", "open data commons attribution licen[cs]e ~version|v ~1|v1 ~0"),
    ("pddl-1", "pddl 1 0", "open data commons public domain dedication *2 licen[cs]e"),
    ("elastic-2", "elastic 2 0", "elastic licen[cs]e ~version|v ~2|v2 ~0"),
    ("sspl-1", "sspl 1 0", "server side public licen[cs]e ~version|v ~1|v1 ~0"),
    ("ogl-uk", "ogl uk ~1|2|3 ~0", "open government licen[cs]e ~version|v ~1|2|3|v1|v2|v3 ~0"),
    ("openrail", "openrail", "open rail ~m|s licen[cs]e"),
    ("llama", "llama2|llama3", "llama 2|3 community licen[cs]e ~agreement"),
    ("cc0-1", "cc0 1 0", "cc0 ~1 ~0 ~universal"),
    ("cc0-1", "cc0", "creative commons zero ~version|v ~1|v1 ~0"),
    ("cc-by-nc-nd", "cc by nc nd", "cc by nc nd ~1|2|3|4 ~0|5"),
    ("cc-by-nc-sa", "cc by nc sa", "cc by nc sa ~1|2|3|4 ~0|5"),
    ("cc-by-nc", "cc by nc", "cc by nc ~1|2|3|4 ~0|5"),
    ("cc-by-nd", "cc by nd", "cc by nd ~1|2|3|4 ~0|5"),
    ("cc-by-sa", "cc by sa", "cc by sa ~1|2|3|4 ~0|5"),
    ("cc-by", "cc by", "cc by ~1|2|3|4 ~0|5"),
    ("cc-by-nc-nd", "cc by nc nd", "creative commons attribution non ~commercial no ~deriv(ative)?s ~works"),
    ("cc-by-nc-nd", "cc by nc nd", "creative commons attribution noncommercial noderiv(ative)?s"),
    ("cc-by-nc-sa", "cc by nc sa", "creative commons attribution non commercial share ~alike"),
    ("cc-by-nc-sa", "cc by nc sa", "creative commons attribution noncommercial sharealike"),
    ("cc-by-nc", "cc by nc", "creative commons attribution non commercial"),
    ("cc-by-nc", "cc by nc", "creative commons attribution noncommercial"),
    ("cc-by-nd", "cc by nd", "creative commons attribution noderiv(ative)?s"),
    ("cc-by-sa", "cc by sa", "creative commons attribution share ~alike"),
    ("cc-by-sa", "cc by sa", "creative commons attribution sharealike"),
    ("cc-by", "cc by", "creative commons attribution ~1|2|3|4 ~0|5 ~international|generic|unported"),
    ("cc", "cc", "creative commons licen[cs]e"),
]

#: How a text says that a license applies, before the license's name, by class.
FRAMES = [
    (TAG, "spdx licen[cs]e identifier {id}"),
    (NOTICE, "licen[cs]ed|released|distributed|published|provided|available|covered|offered|shared *2 under ~the ~terms ~of ~the {name}"),
    (NOTICE, "subject|pursuant|according to ~the ~terms ~of ~the {name}"),
    (NOTICE, "redistribute it and or modify it under the terms of ~the {name}"),
    (NAME, "{name}"),
]

#: Class, label and pattern of phrases from license texts, notices without a name, and mere hints.
TEXTS = [
    (NOTICE, "mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    (NOTICE, "mit", "the above copyright notice and this permission notice shall be included in all copies"),
    (NOTICE, "isc", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    (NOTICE, "bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    (NOTICE, "bsd", "redistributions of source code must retain the above copyright notice"),
    (NOTICE, "bsd", "redistributions in binary form must reproduce the above copyright notice"),
    (NOTICE, "bsd-3", "neither the name of *12 may be used to endorse or promote products"),
    (NOTICE, "bsd-4", "all advertising materials mentioning features or use of this software"),
    (NOTICE, "apache-2", "you may not use this file except in compliance with the license"),
    (NOTICE, "apache-2", "unless required by applicable law or agreed to in writing software distributed under the license"),
    (NOTICE, "apache-2", "apache org licenses license 2 0"),
    (NOTICE, "gpl", "this program is free software you can redistribute it and or modify it"),
    (NOTICE, "gpl", "you should have received a copy of the gnu general public license"),
    (NOTICE, "lgpl", "you should have received a copy of the gnu lesser general public license"),
    (NOTICE, "agpl", "you should have received a copy of the gnu affero general public license"),
    (NOTICE, "gpl-2", "either version 2 of the license or at your option any later version"),
    (NOTICE, "gpl-3", "either version 3 of the license or at your option any later version"),
    (NOTICE, "lgpl-2.1", "either version 2 1 of the license or at your option any later version"),
    (NOTICE, "mpl-2", "this source code form is subject to the terms of the mozilla public license"),
    (NOTICE, "mpl-1.1", "the contents of this file are subject to the mozilla public license"),
    (NOTICE, "epl-1", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    (NOTICE, "zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    (NOTICE, "zlib", "altered source versions must be plainly marked as such"),
    (NOTICE, "bsl-1", "permission is hereby granted free of charge to any person or organization obtaining a copy"),
    (NOTICE, "unlicense", "this is free and unencumbered software released into the public domain"),
    (NOTICE, "wtfpl", "you just do what the fuck you want to"),
    (NOTICE, "ofl", "this font software is licensed under the sil open font license"),
    (NOTICE, "public-domain", "dedicated|released|placed to|into|in the public domain"),
    (NOTICE, "public-domain", "this *3 is in the public domain"),
    (NOTICE, "cc0-1", "waived all copyright and related or neighboring rights"),
    (NOTICE, "cc-by", "creativecommons org licenses by ~1|2|3|4 ~0|5"),
    (NOTICE, "cc-by-sa", "creativecommons org licenses by sa ~1|2|3|4 ~0|5"),
    (NOTICE, "cc-by-nc", "creativecommons org licenses by nc ~1|2|3|4 ~0|5"),
    (NOTICE, "cc-by-nd", "creativecommons org licenses by nd ~1|2|3|4 ~0|5"),
    (NOTICE, "cc-by-nc-sa", "creativecommons org licenses by nc sa ~1|2|3|4 ~0|5"),
    (NOTICE, "cc-by-nc-nd", "creativecommons org licenses by nc nd ~1|2|3|4 ~0|5"),
    (NOTICE, "cc0-1", "creativecommons org publicdomain zero ~1 ~0"),
    (NOTICE, "gpl", "gnu org licenses gpl ~1|2|3 ~0"),
    (NOTICE, "lgpl", "gnu org licenses lgpl ~2|3 ~0|1"),
    (NOTICE, "agpl", "gnu org licenses agpl ~3 ~0"),
    (NOTICE, "mit", "opensource org licenses mit"),
    (NOTICE, "bsd", "opensource org licenses bsd ~2|3 ~clause"),
    (NOTICE, "proprietary", "unauthorized|unauthorised copying of this file via any medium is strictly prohibited"),
    (NOTICE, "proprietary", "proprietary and confidential"),
    (NOTICE, "proprietary", "this *4 is confidential and proprietary"),
    (NOTICE, "proprietary", "may not be reproduced distributed or transmitted in any form"),
    (NOTICE, "proprietary", "no part of this publication may be reproduced"),
    (NOTICE, "non-commercial", "for non commercial use only"),
    (NOTICE, "non-commercial", "for noncommercial use only"),
    (NOTICE, "non-commercial", "free for personal use only"),
    (NOTICE, "research-only", "for research purposes only"),
    (CLUE, "all-rights-reserved", "all rights reserved"),
    (CLUE, "unknown-license", "see ~the license|licence|copying ~file for ~more|license|licensing details|terms|information"),
    (CLUE, "unknown-license", "use of this source code is governed by"),
    (CLUE, "unknown-license", "released under an open source license"),
    (CLUE, "unknown-license", "free and open source software"),
    (CLUE, "public-domain", "public domain"),
    (CLUE, "gpl", "gpl"), (CLUE, "lgpl", "lgpl"), (CLUE, "agpl", "agpl"), (CLUE, "cc", "creative commons"),
]

#: Words that many texts hold; no rule is gated by them.
_COMMON = frozenset("the of to in and or by is it for a this that under version public general terms software file no not use you free all any".split())


@dataclass(frozen=True)
class Rule:
    rank: int
    kind: int
    label: str
    pattern: str

    @property
    def needs(self) -> list[str]:
        """Words that every match holds, without very common ones; ``license`` also stands for its British spelling."""
        words = ["license" if w == "licen[cs]e" else w for w in self.pattern.split()]
        return sorted({w for w in words if re.fullmatch("[a-z0-9]+", w) and w not in _COMMON})

    @property
    def keyword(self) -> str:
        """The word that gates the rule: the longest of its needs but ``license``."""
        return max(self.needs, key=lambda w: (w != "license", len(w), w))


def all_rules() -> list[Rule]:
    """Every rule, first those of the fixed phrases; the rank is the place in the list."""
    made = [(BASE, label, phrase) for label, phrase in PHRASES]
    made += [(kind, label, frame.format(id=tag, name=name)) for kind, frame in FRAMES for label, tag, name in LICENSES]
    made += TEXTS
    return [Rule(i, *m) for i, m in enumerate(dict.fromkeys(made))]
