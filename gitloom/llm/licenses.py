"""Licenses that texts name or quote, by ordered signature rules.

A rule is a regex over the words of a text, gated by a keyword that each of its matches
holds: one automaton finds the keywords, and a rule looks only at the places around its own.
The order of the rules is their priority. A detection that lies inside one of higher
priority is suppressed, so ``the mit license`` says nothing more where a whole notice stands.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gitloom.llm.common import extended, small_batches, utf8, with_columns, without
from gitloom.llm.decontamination import normalise

#: No match of a rule is longer than this many bytes (a test measures the rules).
REACH = 512
#: Bytes of a text whose words are in Python at once.
WORD_BYTES = 1 << 20


@dataclass(frozen=True)
class Rule:
    """``pattern`` is written over words with one space between, ``\x20?`` for one that may be
    absent; each of its matches holds one of ``keywords``.
    """

    label: str
    kind: str
    pattern: str
    keywords: tuple[str, ...]
    weight: float

    @property
    def regex(self) -> str:
        """Over a line in which each word has a space on both sides; it eats those at its ends."""
        return f" {self.pattern.replace(' ?', '\0').replace(' ', '  ').replace('\0', '(?:  )?')} "

    @property
    def stays(self) -> bool:
        """Detections of base rules are never suppressed."""
        return self.kind == "base"


# --- fixed values: the base phrases ---
BASE = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

# Macros of the patterns below: the spellings of a word, and of versions.
MACROS = {
    "<L>": "licen[cs]e",
    "<1>": "(?:version 1|v1|v 1|1)(?: 0)?",
    "<1.1>": "(?:version 1|v1|v 1|1) 1",
    "<2>": "(?:version 2|v2|v 2|2)(?: 0)?",
    "<2.1>": "(?:version 2|v2|v 2|2) 1",
    "<3>": "(?:version 3|v3|v 3|3)(?: 0)?",
    "<n>": "(?:version |v )?v?[1-4](?: 0| 5)?",
    "<later>": "(?:or|and) (?:at your option )?(?:any )?later(?: versions?)?",
    "<gpl>": "(?:gnu )?general public <L>",
    "<cc>": "(?:creative commons|cc)",
    "<by>": "(?:by|attribution)",
    "<nc>": "(?:nc|non ?commercial)",
    "<nd>": "(?:nd|no ?deriv(?:ative|ative work)?s?)",
    "<sa>": "(?:sa|share ?alike)",
}

# Whole phrases of license texts and notices: label | weight | keyword | pattern.
CLAUSES = """
mit | 0.95 | permission is hereby granted free | permission is hereby granted free of charge to any person obtaining a copy
mit | 0.8 | without limitation the rights to use | without limitation the rights to use copy modify merge publish distribute sublicense and or sell
mit | 0.75 | above copyright notice and this permission | the above copyright notice and this permission notice (?:including the next paragraph )?shall be included in all copies
mit-0 | 0.7 | permission is hereby granted free | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction
isc | 0.95 | for any purpose with or without fee | permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted
isc | 0.7 | the author disclaims all warranties | the author disclaims all warranties with regard to this software
bsd | 0.8 | redistribution and use in source | redistribution and use in source and binary forms with or without modification are permitted
bsd-2-clause | 0.75 | redistributions in binary form must | redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer
bsd-3-clause | 0.9 | neither the name of | neither the name of (?:the )?(?:copyright holders?|author|authors|project|company|organization|university) nor the names of (?:its|their|any) contributors
bsd-4-clause | 0.95 | all advertising materials mentioning | all advertising materials mentioning features or use of this software must display
apache-2 | 0.9 | unless required by applicable law | unless required by applicable law or agreed to in writing software distributed under the <L> is distributed on an as is basis
apache-2 | 0.8 | not use this file except in | you may not use this file except in compliance with the <L>
apache-2 | 0.7 | terms and conditions for use reproduction | terms and conditions for use reproduction and distribution
gpl-3-or-later | 0.95 | free software foundation either version 3 | published by the free software foundation either version 3 of the <L> or (?:at your option )?any later version
gpl-2-or-later | 0.95 | free software foundation either version 2 | published by the free software foundation either version 2 of the <L> or (?:at your option )?any later version
gpl | 0.7 | this program is free software | this program is free software you can redistribute it and or modify it under the terms of
gpl | 0.6 | distributed in the hope that it will | distributed in the hope that it will be useful but without any warranty
lgpl | 0.8 | this library is free software | this library is free software you can redistribute it and or modify it under the terms of
agpl | 0.7 | remote network interaction | remote network interaction use with the gnu general public <L>
mpl-2 | 0.95 | subject to the terms of the mozilla | this source code form is subject to the terms of the mozilla public <L> v 2 0
mpl-2 | 0.8 | if a copy of the mpl was not | if a copy of the mpl was not distributed with this file you can obtain one
mpl-1.1 | 0.9 | subject to the mozilla public | the contents of this file are subject to the mozilla public <L> <1.1>
epl-2 | 0.9 | program and the accompanying materials | this program and the accompanying materials are made available under the terms of the eclipse public <L> <2>
epl-1 | 0.9 | program and the accompanying materials | this program and the accompanying materials are made available under the terms of the eclipse public <L> <1>
cddl-1 | 0.9 | common development and distribution | subject to the terms of the common development and distribution <L>
unlicense | 0.95 | free and unencumbered software | this is free and unencumbered software released into the public domain
cc0-1 | 0.9 | to the extent possible under law | to the extent possible under law (?:the )?(?:author|authors|person|person who associated cc0 with this work)(?: s)? (?:has|have) waived all copyright
wtfpl | 0.95 | what the fuck you want | do what the fuck you want to(?: public <L>)?
zlib | 0.9 | must not be misrepresented you must not | the origin of this software must not be misrepresented you must not claim that you wrote the original software
zlib | 0.8 | altered source versions must be | altered source versions must be plainly marked as such
boost-1 | 0.9 | machine executable object code generated | machine executable object code generated by a source language processor
artistic-2 | 0.8 | establishes the terms under which | this <L> establishes the terms under which a given free software package may be copied modified distributed
ofl-1.1 | 0.9 | font software may be sold by itself | neither the font software nor any of its individual components in original or modified versions may be sold by itself
ofl-1.1 | 0.8 | reserved font name | with reserved font name
openssl | 0.9 | for use in the openssl toolkit | software developed by the openssl project for use in the openssl toolkit
php-3 | 0.9 | includes php software freely | this product includes php software freely available from
python-2 | 0.8 | python software foundation hereby grants | python software foundation hereby grants you a nonexclusive royalty free world wide <L>
ms-pl | 0.8 | microsoft public | this <L> governs use of the accompanying software if you use the software you accept this <L>
json | 0.9 | shall be used for good not evil | the software shall be used for good not evil
beerware | 0.9 | buy me a beer in return | you can buy me a beer in return
gfdl | 0.9 | gnu free documentation | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation <L>
public-domain | 0.9 | into the public domain | (?:is|are|been|was|were|hereby) (?:released|placed|dedicated|put) (?:in)?to the public domain
public-domain | 0.8 | in the public domain | (?:this|the) (?:work|text|file|software|image|document|code|book) is in the public domain
public-domain | 0.8 | public domain | (?:dedicated|donated) to the public domain
proprietary | 0.8 | proprietary and confidential | (?:strictly )?proprietary and confidential
proprietary | 0.8 | unauthorized copying of this | unauthorized copying of this file via any medium is strictly prohibited
proprietary | 0.7 | may be reproduced | no part of this (?:publication|book|work|document) may be reproduced
proprietary | 0.7 | without prior written permission | (?:reproduced|distributed|copied|used) (?:in any form )?without (?:the )?prior written permission
proprietary | 0.6 | internal use only | for internal use only
all-rights-reserved | 0.6 | rights reserved | all rights (?:are )?reserved
all-rights-reserved | 0.6 | droits réservés | tous droits réservés
all-rights-reserved | 0.6 | rechte vorbehalten | alle rechte vorbehalten
all-rights-reserved | 0.6 | derechos reservados | todos los derechos reservados
"""

# Families, the narrower before the wider: label | name | its keyword | id as short form |
# its keyword | what follows a host in an address | its keyword. A dash stands for none.
FAMILIES = """
agpl-3-or-later | (?:gnu )?affero <gpl> <3> <later> | affero | agpl ?(?:<3>) <later> | agpl | - | -
agpl-3 | (?:gnu )?affero <gpl> <3> | affero | agpl ?(?:<3>)(?: only)? | agpl | gnu org licenses agpl 3 0 | licenses agpl
agpl | (?:gnu )?affero <gpl> | affero | (?:gnu )?agpl | agpl | gnu org licenses agpl | licenses agpl
lgpl-3-or-later | (?:gnu )?(?:lesser|library) <gpl> <3> <later> | general public licen | lgpl ?(?:<3>) <later> | lgpl | - | -
lgpl-2.1-or-later | (?:gnu )?(?:lesser|library) <gpl> <2.1> <later> | general public licen | lgpl ?(?:<2.1>) <later> | lgpl | - | -
lgpl-3 | (?:gnu )?(?:lesser|library) <gpl> <3> | general public licen | lgpl ?(?:<3>)(?: only)? | lgpl | gnu org licenses lgpl 3 0 | licenses lgpl
lgpl-2.1 | (?:gnu )?(?:lesser|library) <gpl> <2.1> | general public licen | lgpl ?(?:<2.1>)(?: only)? | lgpl | gnu org licenses (?:old licenses )?lgpl 2 1 | lgpl 2 1
lgpl-2 | (?:gnu )?(?:lesser|library) <gpl> <2> | general public licen | lgpl ?(?:<2>)(?: only)? | lgpl | gnu org licenses (?:old licenses )?lgpl 2 0 | lgpl 2 0
lgpl | (?:gnu )?(?:lesser|library) <gpl> | general public licen | (?:gnu )?lgpl | lgpl | gnu org licenses lgpl | licenses lgpl
gpl-3-or-later | <gpl> <3> <later> | general public licen | gpl ?(?:<3>) <later> | gpl | - | -
gpl-2-or-later | <gpl> <2> <later> | general public licen | gpl ?(?:<2>) <later> | gpl | - | -
gpl-3 | <gpl> <3> | general public licen | gpl ?(?:<3>)(?: only)? | gpl | gnu org licenses gpl 3 0 | licenses gpl
gpl-2 | <gpl> <2> | general public licen | gpl ?(?:<2>)(?: only)? | gpl | gnu org licenses (?:old licenses )?gpl 2 0 | gpl 2 0
gpl-1 | <gpl> <1> | general public licen | gpl ?(?:<1>)(?: only)? | gpl | gnu org licenses old licenses gpl 1 0 | gpl 1 0
gpl | <gpl> | general public licen | (?:gnu gpl|gpl) | gpl | gnu org licenses gpl | licenses gpl
gfdl | (?:gnu )?free documentation <L> | documentation licen | gfdl(?: 1 [1-3])? | gfdl | gnu org licenses fdl | licenses fdl
cc-by-nc-nd | <cc> <by> <nc> <nd> | creative commons or cc by or cc attribution | cc by nc nd(?: <n>)? | cc by nc nd | creativecommons org licenses by nc nd | by nc nd
cc-by-nc-sa | <cc> <by> <nc> <sa> | creative commons or cc by or cc attribution | cc by nc sa(?: <n>)? | cc by nc sa | creativecommons org licenses by nc sa | by nc sa
cc-by-nc | <cc> <by> <nc> | creative commons or cc by or cc attribution | cc by nc(?: <n>)? | cc by nc | creativecommons org licenses by nc | by nc
cc-by-nd | <cc> <by> <nd> | creative commons or cc by or cc attribution | cc by nd(?: <n>)? | cc by nd | creativecommons org licenses by nd | by nd
cc-by-sa | <cc> <by> <sa> | creative commons or cc by or cc attribution | cc by sa(?: <n>)? | cc by sa | creativecommons org licenses by sa | by sa
cc-by | <cc> <by> | creative commons or cc by or cc attribution | cc by(?: <n>)? | cc by | creativecommons org licenses by | licenses by
cc0-1 | <cc> (?:cc0|0|zero)(?: 1 0)?(?: universal)? | cc0 or cc 0 or zero or commons 0 | cc ?0(?: 1 0)?(?: universal)? | cc0 or cc 0 | creativecommons org publicdomain zero | publicdomain zero
cc | creative commons(?: <L>| licen[cs]ing)? | creative commons | creative commons | creative commons | creativecommons org licenses | creativecommons org
apache-2 | apache (?:software )?<L> <2> | apache | apache <2> | apache | apache org licenses <L> 2 0 | apache org
apache-1.1 | apache (?:software )?<L> <1.1> | apache | apache <1.1> | apache | apache org licenses <L> 1 1 | apache org
apache-1 | apache (?:software )?<L> <1> | apache | apache <1> | apache | apache org licenses <L> 1 0 | apache org
apache | apache (?:software )?<L> | apache | asl <2> | asl | apache org licenses | apache org
mit-0 | mit (?:no attribution|0) <L> | mit | mit 0 | mit 0 | opensource org licenses mit 0 | licenses mit
mit | mit(?: x11| expat)? <L> | mit licen or x11 licen or expat licen | (?:mit|expat) licensed | licensed | opensource org licenses mit | licenses mit
x11 | x11(?: mit)? <L> | x11 | x11 licensed | x11 | x org licenses | x org
isc | isc <L> | isc licen | isc licensed | isc | opensource org licenses isc | licenses isc
bsd-4-clause | (?:original|old|4 clause|four clause) bsd <L> | bsd | bsd 4 clause | bsd 4 | spdx org licenses bsd 4 clause | licenses bsd
bsd-3-clause | (?:new|modified|revised|3 clause|three clause) bsd <L> | bsd | bsd 3 clause | bsd 3 | opensource org licenses bsd 3 clause | licenses bsd
bsd-2-clause | (?:simplified|freebsd|2 clause|two clause) bsd <L> | bsd | bsd 2 clause | bsd 2 | opensource org licenses bsd 2 clause | licenses bsd
bsd-zero | (?:zero clause|0 clause|free public) bsd <L> | bsd | 0bsd | 0bsd | opensource org licenses 0bsd | 0bsd
bsd | bsd(?: style)? <L> | bsd | (?:bsd licensed|bsd style) | bsd | opensource org licenses bsd | licenses bsd
mpl-2 | mozilla public <L> <2> | mozilla | mpl ?(?:<2>) | mpl | mozilla org mpl 2 0 | mpl 2 0
mpl-1.1 | mozilla public <L> <1.1> | mozilla | mpl ?(?:<1.1>) | mpl | mozilla org mpl mpl 1 1 | mpl 1 1
mpl | mozilla public <L> | mozilla | mpl licensed | mpl | mozilla org mpl | mozilla org
epl-2 | eclipse public <L> <2> | eclipse | epl ?(?:<2>) | epl | eclipse org legal epl 2 0 | epl 2 0
epl-1 | eclipse public <L> <1> | eclipse | epl ?(?:<1>) | epl | eclipse org legal epl v10 | epl v10
epl | eclipse public <L> | eclipse | epl licensed | epl | eclipse org legal | eclipse org
edl-1 | eclipse distribution <L> | eclipse | edl ?(?:<1>) | edl | eclipse org org documents edl | documents edl
eupl-1.2 | european union public <L>(?: (?:version |v ?)?1 2)? | european | eupl(?: v?1 2)? | eupl | joinup ec europa eu | joinup
cddl-1.1 | common development and distribution <L> <1.1> | distribution licen | cddl ?(?:<1.1>) | cddl | - | -
cddl-1 | common development and distribution <L>(?: <1>)? | distribution licen | cddl(?: 1 0)? | cddl | opensource org licenses cddl | licenses cddl
cpl-1 | common public <L>(?: <1>)? | common public | cpl 1 0 | cpl | opensource org licenses cpl | licenses cpl
ipl-1 | ibm public <L>(?: <1>)? | ibm public | ipl 1 0 | ipl | opensource org licenses ibmpl | ibmpl
unlicense | the unlicen[cs]e | unlicen | unlicensed work | unlicensed | unlicense org | unlicense org
wtfpl | do what the fuck you want to public <L> | fuck | wtfpl(?: v?2)? | wtfpl | wtfpl net | wtfpl net
zlib | zlib(?: libpng)? <L> | zlib | zlib libpng | zlib | opensource org licenses zlib | licenses zlib
boost-1 | boost software <L>(?: <1>)? | boost | bsl 1 0 | bsl | boost org <L> 1 0 | boost org
artistic-2 | artistic <L> <2> | artistic | artistic <2> | artistic | opensource org licenses artistic <L> 2 0 | artistic
artistic-1 | (?:perl )?artistic <L>(?: <1>)? | artistic | artistic perl | artistic | opensource org licenses artistic | licenses artistic
perl | same terms as perl(?: itself)? | perl | perl licensed | perl | dev perl org licenses | perl org
php-3 | php <L>(?: <3>)?(?: 01)? | php | php licensed | php | php net <L> | php net
python-2 | (?:python software foundation|psf|python) <L>(?: <2>)? | foundation licen or psf licen or python licen | psf licensed | psf | python org psf <L> | python org
ruby | ruby <L> | ruby | ruby licensed | ruby | ruby lang org en about <L> | ruby lang
openssl | openssl(?: ssleay)? <L> | openssl | openssl licensed | openssl | openssl org source <L> | openssl org
ofl-1.1 | (?:sil )?open font <L>(?: (?:version |v ?)?1 1)? | font licen | (?:sil )?ofl(?: v?1 1)? | ofl | scripts sil org ofl | sil org
odbl-1 | (?:odc )?open database <L>(?: <1>)? | database licen | odbl(?: 1 0)? | odbl | opendatacommons org licenses odbl | licenses odbl
odc-by-1 | open data commons attribution <L>(?: <1>)? | commons attribution | odc by(?: 1 0)? | odc by | opendatacommons org licenses by | opendatacommons
pddl-1 | (?:odc )?public domain dedication and <L> | dedication and | pddl(?: 1 0)? | pddl | opendatacommons org licenses pddl | licenses pddl
ogl-3 | open government <L>(?: (?:for public sector information )?<3>)? | government licen | ogl(?: v?3 0| v?3)? | ogl | nationalarchives gov uk doc open government | nationalarchives
etalab-2 | (?:etalab )?(?:licence ouverte|open <L>) etalab(?: 2 0)? | etalab | etalab 2 0 | etalab | etalab gouv fr | etalab gouv
dl-de-by-2 | datenlizenz deutschland namensnennung(?: 2 0)? | datenlizenz | dl de by 2 0 | dl de | govdata de dl de | govdata
ms-pl | microsoft public <L> | microsoft | ms pl | ms pl | opensource org licenses ms pl | ms pl
ms-rl | microsoft reciprocal <L> | microsoft | ms rl | ms rl | opensource org licenses ms rl | ms rl
sspl-1 | server side public <L>(?: <1>)? | side public | sspl(?: v?1)? | sspl | mongodb com licensing server side | server side
busl-1.1 | business source <L>(?: (?:version |v ?)?1 1)? | business source | busl 1 1 | busl | mariadb com bsl11 | bsl11
elastic-2 | elastic <L>(?: <2>)? | elastic | elastic licensed | elastic | elastic co licensing elastic | elastic co
llama-2 | llama (?:2|3) community <L>(?: agreement)? | llama | llama (?:2|3) licensed | llama | ai meta com llama <L> | llama
openrail-m | (?:creativeml |bigscience |bigcode )?open ?rail(?: m)? <L> | rail | (?:creativeml )?openrail m | openrail | huggingface co spaces (?:bigscience|compvis) | huggingface
postgresql | postgresql <L> | postgresql | postgresql licensed | postgresql | postgresql org about licen[cs]e | postgresql org
vim | vim <L> | vim licen | vim licensed | vim | vimhelp org uganda | vimhelp
ncsa | (?:university of illinois )?(?:illinois )?ncsa(?: open source)? <L> | ncsa | uiuc ncsa | ncsa | opensource org licenses ncsa | licenses ncsa
w3c | w3c(?: software)?(?: notice and)? <L> | w3c | w3c licensed | w3c | w3 org consortium legal | w3 org
icu | icu <L> | icu licen | icu licensed | icu | unicode org copyright | unicode org
tcl | tcl(?: tk)? <L> | tcl | tcl tk licensed | tcl | tcl tk software tcltk <L> | tcltk
upl-1 | universal permissive <L>(?: <1>)? | permissive licen | upl 1 0 | upl | oss oracle com licenses upl | licenses upl
oracle-bcl | oracle binary code <L> | binary code | oracle bcl | bcl | oracle com technetwork java javase terms <L> | technetwork
afl-3 | academic free <L>(?: <3>)? | academic free | afl 3 0 | afl | opensource org licenses afl 3 0 | licenses afl
osl-3 | open software <L>(?: <3>)? | software licen | osl 3 0 | osl | opensource org licenses osl 3 0 | licenses osl
mulan-2 | mulan (?:psl|permissive software <L>)(?: <2>)? | mulan | mulanpsl 2 0 | mulanpsl | <L> coscl org cn mulanpsl2 | coscl
"""

#: Forms of a family's name and ids, the surer first: kind, weight.
FORMS = (("spdx", 1.0), ("notice", 0.95), ("address", 0.9), ("title", 0.7), ("id", 0.5))
GRANTS = (
    "(?:licen[cs]ed|released|distributed|available|published|provided|offered|shared|covered|redistributed|used|"
    "sublicensed|relicensed|governed|subject) (?:for use )?(?:under|by|to|with|through) (?:the terms (?:and conditions )?of )?(?:an? |the )?"
)


def _expanded(pattern: str) -> str:
    while any(m in pattern for m in MACROS):
        for macro, meaning in MACROS.items():
            pattern = pattern.replace(macro, f"(?:{meaning})" if "|" in meaning else meaning)
    return pattern


def _fields(line: str) -> list[str]:
    return [part.strip() for part in re.split(r"\s\|\s", line)]


def build_rules() -> tuple[Rule, ...]:
    """All rules in order: base phrases, whole clauses, then the forms of each family."""
    rules = [Rule(label, "base", phrase, (phrase,), 1.0) for label, phrase in BASE]
    for line in CLAUSES.strip().splitlines():
        label, weight, keyword, pattern = _fields(line)
        rules.append(Rule(label, "clause", _expanded(pattern), (keyword,), float(weight)))
    families = [_fields(line) for line in FAMILIES.strip().splitlines()]
    for kind, weight in FORMS:
        for label, name, named, short, shortened, address, addressed in families:
            pattern, keywords = {
                "spdx": (f"spdx <L> identifier (?:{short})", "spdx"),
                "notice": (f"{GRANTS}(?:{name}|{short})", f"{named} or {shortened}"),
                "address": (address, addressed),
                "title": (name, named),
                "id": (short, shortened),
            }[kind]
            if pattern != "-":
                words = tuple(dict.fromkeys(keywords.split(" or ")))
                rules.append(Rule(label, kind, _expanded(pattern), words, weight))
    return tuple(rules)


RULES = build_rules()


def spaced(text: bytes) -> bytes:
    """The words of a text in lower case, each with a space on both sides."""
    plain, parts, start = normalise(text), [], 0
    while start < len(plain):
        end = plain.find(b" ", start + WORD_BYTES)
        end = len(plain) if end < 0 else end
        parts.append(b"  ".join(plain[start:end].split()))
        start = end
    line = b"  ".join(p for p in parts if p)
    return b" %b " % line if line else b""


def around(ends: list[int], length: int) -> Iterator[tuple[int, int]]:
    """Stretches of a line within reach of the places, merged where they meet."""
    lo, hi = None, -1
    for end in sorted(ends):
        if lo is None or end - REACH > hi:
            if lo is not None:
                yield lo, hi
            lo = max(0, end - REACH)
        hi = min(length, end + REACH)
    if lo is not None:
        yield lo, hi


def suppressed(found: list[tuple[int, int, int]], rules: tuple[Rule, ...]) -> list[tuple[int, int, int]]:
    """Of ``first, after, rule`` those that lie in none of a rule before theirs, by place.

    One pass by place: only detections that reach beyond the start of the next are looked
    at, and those are few, as a detection has a bounded number of words.
    """
    out, over = [], []
    for first, after, rule in sorted(found, key=lambda x: (x[0], -x[1], x[2])):
        over = [x for x in over if x[1] > first]
        inside = any(x[1] >= after and x[2] < rule for x in over)
        if rules[rule].stays or not inside:
            out.append((first, after, rule))
        over.append((first, after, rule))
    return out


class Scanner:
    """The rules of one task; a regex is compiled when its keyword is first met."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        gates = defaultdict(set)
        for i, rule in enumerate(rules):
            for word in rule.keywords:
                gates[word.replace(" ", "  ")].add(i)
        self.gate = ahocorasick.Automaton()
        for word, numbers in gates.items():
            self.gate.add_word(word.encode().decode("latin-1"), tuple(sorted(numbers)))
        if gates:
            self.gate.make_automaton()
        self.compiled: dict[int, re.Pattern] = {}

    def matches(self, line: bytes) -> list[tuple[int, int, int]]:
        """``start, end, rule`` of all matches in a spaced line, by place."""
        places = defaultdict(list)
        if line and len(self.gate):
            for end, numbers in self.gate.iter(line.decode("latin-1")):
                for i in numbers:
                    places[i].append(end)
        found = []
        for i, ends in places.items():
            if i not in self.compiled:
                self.compiled[i] = re.compile(self.rules[i].regex.encode())
            for lo, hi in around(ends, len(line)):
                found += [(*m.span(), i) for m in self.compiled[i].finditer(line, lo, hi)]
        return sorted(found)

    def detections(self, line: bytes) -> list[tuple[int, int, int]]:
        """``first word, after the last, rule`` of what is not suppressed."""
        found, word, seen = [], 0, 0
        for start, end, rule in self.matches(line):
            word += line.count(b" ", seen, start)
            seen = start
            found.append((word // 2, (word + line.count(b" ", start, end)) // 2, rule))
        return suppressed(found, self.rules)


def word_count(line: bytes) -> int:
    return line.count(b" ") // 2


def character_spans(text: bytes, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """First character and the one after the last of ranges of words, in one pass of the text."""
    if not ranges:
        return []
    plain = np.frombuffer(b" %b " % normalise(text), np.uint8) != 0x20
    starts = np.flatnonzero(plain[1:] & ~plain[:-1])
    ends = np.flatnonzero(plain[:-1] & ~plain[1:])
    # Characters begin at bytes that continue none.
    begun = np.cumsum(np.concatenate([[0], (np.frombuffer(text, np.uint8) & 0xC0) != 0x80]))
    return [(int(begun[starts[a]]), int(begun[ends[b - 1]])) for a, b in ranges]


_DETECTION = (
    T.StructType()
    .add("label", T.StringType())
    .add("kind", T.StringType())
    .add("rule", T.IntegerType())
    .add("weight", T.DoubleType())
    .add("first_word", T.LongType())
    .add("n_words", T.LongType())
    .add("start", T.LongType())
    .add("end", T.LongType())
)


def scan_licenses(docs: DataFrame, rules: Iterable[Rule] = RULES, text: str = "text") -> DataFrame:
    """Add ``n_words`` (long) and ``licenses``, the detections that stand, by place.

    A detection has the rule's label, kind, number and weight, its first word and how many
    it has, and the characters that it covers in the original text. Words are runs of ASCII
    letters, digits and all characters beyond ASCII, with A-Z in lower case. Null and empty
    texts have no words and no detections; of rules that match at the same words the first
    stands; repeated rows are scanned alike; columns of the added names are replaced.
    """
    base, rules = without(docs, "n_words", "licenses"), tuple(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in small_batches(batches, text):
            counts, rows = [], []
            for data in utf8(batch, text):
                line = spaced(data)
                counts.append(word_count(line))
                found = scanner.detections(line)
                spans = character_spans(data, [(a, b) for a, b, _ in found])
                rows.append(
                    [
                        (rules[i].label, rules[i].kind, i, rules[i].weight, a, b - a, *span)
                        for (a, b, i), span in zip(found, spans, strict=True)
                    ]
                )
            kind = pa.list_(
                pa.struct(
                    [
                        ("label", pa.string()),
                        ("kind", pa.string()),
                        ("rule", pa.int32()),
                        ("weight", pa.float64()),
                        *[(n, pa.int64()) for n in ("first_word", "n_words", "start", "end")],
                    ]
                )
            )
            names = _DETECTION.names
            named = [[dict(zip(names, d, strict=True)) for d in row] for row in rows]
            yield with_columns(batch, n_words=pa.array(counts, pa.int64()), licenses=pa.array(named, kind))

    added = extended(base.schema, n_words=T.LongType(), licenses=T.ArrayType(_DETECTION))
    return base.mapInArrow(run, added)


def labels_of(detections: Column) -> Column:
    """Distinct labels, sorted, with commas between."""
    return F.array_join(F.array_sort(F.array_distinct(detections["label"])), ",")


def score_of(detections: Column) -> Column:
    """How sure the surest detection is: its weight, 0 without one."""
    return F.coalesce(F.array_max(detections["weight"]), F.lit(0.0))
