"""Ordered signature rules of licences, written by hand as regular expressions over normalised words.

A text is read as lower-case words with one space between.  Each pattern marks one plain word of its own with ``>``,
the rule's keyword: only where a text has that word is the pattern tried, on the words around it.  A pattern covers at
most ``REACH`` words before its keyword and as many after.
"""

from __future__ import annotations

import re
from typing import NamedTuple

#: Words before and after a keyword that a pattern can see.
REACH = 24

#: Priority levels, best first, and how sure a detection of each is.
TAG, TEXT, NOTICE, TITLE, NAME = range(5)
CONFIDENCE = [0.99, 0.95, 0.9, 0.8, 0.6]

_FORMS = {"V1": "(?:v1|version 1|1)(?: 0)?", "V2": "(?:v2|version 2|2)(?: 0)?", "V3": "(?:v3|version 3|3)(?: 0)?",
          "LIC": "(?:license|licence)", "LATER": "(?: or(?: at your option)?(?: any)? later(?: version)?)"}

#: label: titles with a version || bare names || identifiers (of licence tags).  V1, V2, V3, LIC and LATER are in _FORMS.
FAMILIES = """
mit: || mit >license | mit >licence | expat >license | mit x11 >license | mit expat >license | mit style >license || mit | mit 0 | mit modern variant
x11: || x11 >license | x >consortium license || x11
apache: >apache (?:software )?LIC V2 | >apache 2 0 | >asl 2 0 || apache >license | apache >licence | apache software >license || apache 2 0
apache-1: >apache (?:software )?LIC (?:version |v)?1(?: 0| 1) || || apache 1 0 | apache 1 1
gpl-2-only: gnu >gpl V2 only | >gplv2 only | gnu general >public LIC V2 only || || gpl 2 0 only
gpl-2: gnu >gpl V2LATER? | >gplv2 | >gpl V2 | general >public LIC V2LATER? || || gpl 2 0 | gpl 2 0 or later
gpl-3: gnu >gpl V3LATER? | >gplv3 | >gpl V3 | general >public LIC V3LATER? || || gpl 3 0 | gpl 3 0 only | gpl 3 0 or later
gpl: || gnu general >public license | general >public license | gnu >gpl | >gpl LIC | gnu >copyleft || gpl 1 0 or later
lgpl-2-1: gnu >lgpl (?:v|version )?2 1 | >lgplv2 1 | >lesser general public LIC (?:version |v)?2 1LATER? || || lgpl 2 1 | lgpl 2 1 only | lgpl 2 1 or later
lgpl-3: gnu >lgpl V3 | >lgplv3 | >lesser general public LIC V3LATER? || || lgpl 3 0 | lgpl 3 0 only | lgpl 3 0 or later
lgpl: || gnu >lesser general public LIC | >lesser general public LIC | >lgpl | gnu >library general public LIC || lgpl 2 0 or later
agpl-3: gnu >agpl V3 | >agplv3 | >affero general public LIC V3LATER? || || agpl 3 0 | agpl 3 0 only | agpl 3 0 or later
agpl: || gnu >affero general public LIC | >affero general public LIC | >agpl || agpl 1 0
gfdl: >gfdl 1 (?:1|2|3) | gnu free >documentation LIC (?:version |v)?1 (?:1|2|3) || free >documentation LIC | gnu >fdl || gfdl 1 1 or later | gfdl 1 2 or later | gfdl 1 3 or later
bsd-2: 2 clause >bsd | two clause >bsd | simplified >bsd | >freebsd LIC || || bsd 2 clause | bsd 2 clause patent
bsd-3: 3 clause >bsd | three clause >bsd | new >bsd LIC | modified >bsd LIC | revised >bsd LIC || || bsd 3 clause | bsd 3 clause clear | bsd 3 clause lbnl
bsd-4: 4 clause >bsd | four clause >bsd | original >bsd LIC || || bsd 4 clause
bsd-0: 0 clause >bsd | zero clause >bsd || || 0bsd
bsd: || >bsd LIC | >bsd style LIC | >berkeley software distribution LIC || bsd source code
mpl-1: >mozilla public LIC (?:version |v)?1 (?:0|1) | >mpl 1 (?:0|1) || || mpl 1 0 | mpl 1 1
mpl-2: >mozilla public LIC V2 | >mpl 2 0 | >mplv2 || || mpl 2 0 | mpl 2 0 no copyleft exception
mpl: || >mozilla public LIC || mpl
epl-1: >eclipse public LIC V1 | >epl 1 0 || || epl 1 0
epl-2: >eclipse public LIC V2 | >epl 2 0 || || epl 2 0
epl: || >eclipse public LIC | eclipse >distribution LIC || epl
cddl: >cddl 1 (?:0|1) || common >development and distribution LIC | >cddl || cddl 1 0 | cddl 1 1
cpl: common public >license V1 || common public >license | >cpl 1 0 || cpl 1 0
ipl: ibm public >license V1 || ibm public >license || ipl 1 0
eupl: >eupl (?:v)?1 (?:1|2) | >eupl V1 || european union public >licence | european union public >license | >eupl || eupl 1 1 | eupl 1 2
isc: || isc >license | isc >licence || isc
zlib: || >zlib LIC | >zlib libpng LIC | >libpng LIC || zlib | libpng 2 0
bsl: >boost software LIC V1 || >boost software LIC || bsl 1 0
artistic: >artistic LIC V2 | >artistic LIC V1 || >artistic LIC | clarified >artistic LIC | perl >artistic LIC || artistic 1 0 | artistic 2 0
unlicense: || >unlicense | the >unlicense || unlicense
wtfpl: >wtfpl version 2 || >wtfpl | do what the (?:fuck|f) you want to public >license || wtfpl
cc0: >cc0 1 0(?: universal)? || >cc0 | creative commons >zero || cc0 1 0
cc-by: >cc by (?:1|2|2 5|3|4)(?: 0)? | creative >commons attribution (?:1|2|2 5|3|4)(?: 0)?(?: international| unported| generic)? || >cc by | creative >commons attribution || cc by 1 0 | cc by 2 0 | cc by 2 5 | cc by 3 0 | cc by 4 0
cc-by-sa: >cc by sa (?:1|2|2 5|3|4)(?: 0)? | creative >commons attribution share ?alike (?:1|2|2 5|3|4)(?: 0)?(?: international| unported| generic)? || >cc by sa | creative >commons attribution share ?alike || cc by sa 2 0 | cc by sa 2 5 | cc by sa 3 0 | cc by sa 4 0
cc-by-nc: >cc by nc (?:1|2|2 5|3|4)(?: 0)? | creative >commons attribution non ?commercial (?:1|2|2 5|3|4)(?: 0)?(?: international| unported| generic)? || >cc by nc | creative >commons attribution non ?commercial || cc by nc 2 0 | cc by nc 3 0 | cc by nc 4 0
cc-by-nd: >cc by nd (?:1|2|2 5|3|4)(?: 0)? | creative >commons attribution no ?deriv(?:ative)?s(?: works)? (?:1|2|2 5|3|4)(?: 0)? || >cc by nd | creative >commons attribution no ?deriv(?:ative)?s || cc by nd 2 0 | cc by nd 3 0 | cc by nd 4 0
cc-by-nc-sa: >cc by nc sa (?:1|2|2 5|3|4)(?: 0)? | creative >commons attribution non ?commercial share ?alike (?:1|2|2 5|3|4)(?: 0)? || >cc by nc sa | creative >commons attribution non ?commercial share ?alike || cc by nc sa 3 0 | cc by nc sa 4 0
cc-by-nc-nd: >cc by nc nd (?:1|2|2 5|3|4)(?: 0)? | creative >commons attribution non ?commercial no ?deriv(?:ative)?s (?:1|2|2 5|3|4)(?: 0)? || >cc by nc nd | creative >commons attribution non ?commercial no ?deriv(?:ative)?s || cc by nc nd 3 0 | cc by nc nd 4 0
creative-commons: || creative >commons LIC | creative >commons public LIC ||
python: >psf LIC version 2 | python software foundation >license version 2 || >psf LIC | python software foundation >license | python >license || python 2 0 | psf 2 0
ruby: || ruby >license | ruby s >license || ruby
php: >php LIC V3 | >php LIC (?:version |v)?3 01 || >php LIC || php 3 0 | php 3 01
postgresql: || >postgresql LIC || postgresql
openssl: || >openssl LIC | >ssleay LIC | >openssl ssleay LIC || openssl
ofl: >ofl 1 (?:0|1) | sil open font >license (?:version |v)?1 1 || open font >license | sil >ofl || ofl 1 0 | ofl 1 1
ms-pl: || microsoft public >license | >ms pl || ms pl
ms-rl: || microsoft reciprocal >license | >ms rl || ms rl
apsl: apple public source >license V2 || apple public source >license || apsl 1 0 | apsl 2 0
osl: open software >license (?:version |v)?3 0 || open software >license || osl 3 0
afl: academic free >license (?:version |v)?3 0 || academic free >license || afl 2 1 | afl 3 0
ecl: educational community >license V2 || educational community >license || ecl 1 0 | ecl 2 0
ncsa: || university of illinois ncsa open source >license | ncsa open source >license || ncsa
upl: universal permissive >license V1 || universal permissive >license || upl 1 0
odbl: open database >license V1 | >odbl 1 0 || open database >license | >odbl || odbl 1 0
odc-by: || open data commons attribution >license || odc by 1 0
pddl: || public domain dedication and >license | >pddl || pddl 1 0
cecill: >cecill (?:v|version )?2(?: 0| 1)? || >cecill b | >cecill c | >cecill || cecill 2 0 | cecill 2 1 | cecill b | cecill c
mulan: >mulan psl V2 | >mulan permissive software LIC V2 || >mulan permissive software LIC || mulanpsl 1 0 | mulanpsl 2 0
sspl: server side public >license V1 || server side public >license | >sspl || sspl 1 0
busl: business source >license (?:version |v)?1 1 || business source >license || busl 1 1
elastic: >elastic LIC V2 || >elastic LIC || elastic 2 0
llama: >llama (?:2|3|3 1|3 2) community LIC || >llama community LIC ||
openrail: >openrail m || >openrail | responsible ai >license ||
polyform: >polyform (?:noncommercial|small business|shield|strict|free trial) LIC 1 0 0 || >polyform LIC || polyform noncommercial 1 0 0 | polyform small business 1 0 0
commons-clause: || commons >clause LIC condition | commons >clause restriction ||
w3c: || >w3c software (?:notice and )?(?:document )?LIC || w3c
json: || >json LIC || json
vim: || >vim LIC || vim
beerware: || >beerware LIC | beer ware >license || beerware
ogl-uk: open government >licence (?:v|version )?(?:1|2|3)(?: 0)? || open government >licence || ogl uk 1 0 | ogl uk 2 0 | ogl uk 3 0
proprietary: || >proprietary and confidential | >proprietary LIC | commercial >license agreement | end user >license agreement ||
public-domain: || dedicated to the public >domain | released into the public >domain | placed in the public >domain ||
"""

#: label: sentences of the licences' own texts and of their usual notices.
SENTENCES = """
mit: permission is hereby >granted free of charge to any person obtaining a copy | the above copyright notice and this permission notice shall be included in all copies or substantial >portions
isc: permission to use copy modify and or >distribute this software for any purpose with or without fee
mit-0: permission is hereby >granted free of charge to any person obtaining a copy of this software to deal in the software without restriction
zlib: this software is provided as is without any express or implied >warranty in no event will the authors be held liable | altered source versions must be plainly >marked as such
bsd: >redistribution and use in source and binary forms with or without modification are permitted | >redistributions of source code must retain the above copyright notice | >redistributions in binary form must reproduce the above copyright notice
bsd-3: neither the name of(?: [^ ]+){1,8} nor the names of its >contributors may be used to endorse
bsd-4: all advertising materials mentioning features or use of this software must display the following >acknowledgement
apache: you may not use this file except in >compliance with the LIC | >apache org licenses LIC 2 0
apache-1: this product includes software developed by the >apache (?:software foundation|group)
gpl: you can >redistribute it and or modify it under the terms of the gnu general public LIC | either version (?:2|3) of the LIC or at your option any >later version | www gnu org >licenses gpl | you should have received a copy of the gnu general >public LIC
gpl-2: either version 2 of the LIC or at your option any >later version | free software foundation inc 51 >franklin street
gpl-3: either version 3 of the LIC or at your option any >later version
lgpl: you can >redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public LIC | www gnu org >licenses lgpl
agpl: you can >redistribute it and or modify it under the terms of the gnu affero general public LIC | www gnu org >licenses agpl
mpl-2: this source code form is subject to the terms of the >mozilla public LIC (?:v|version )?2 0 | >mozilla org mpl 2 0
mpl: >mozilla org mpl
epl: this program and the accompanying materials are made >available under the terms of the eclipse public LIC | >eclipse org legal epl
cddl: the contents of this file are subject to the terms of the common >development and distribution LIC
bsl: permission is hereby >granted free of charge to any person or organization obtaining a copy of the software
unlicense: this is free and >unencumbered software released into the public domain
cc0: >creativecommons org publicdomain zero 1 0
cc-by: >creativecommons org licenses by (?:1|2|2 5|3|4) 0
cc-by-sa: >creativecommons org licenses by sa
cc-by-nc: >creativecommons org licenses by nc (?:1|2|2 5|3|4) 0
cc-by-nd: >creativecommons org licenses by nd
cc-by-nc-sa: >creativecommons org licenses by nc sa
cc-by-nc-nd: >creativecommons org licenses by nc nd
ofl: this font software is licensed under the >sil open font LIC
python: psf is making python available to >licensee on an as is basis
artistic: the intent of this document is to state the conditions under which a package may be copied such that the copyright >holder
wtfpl: everyone is permitted to copy and distribute verbatim or modified >copies of this LIC document and changing it is allowed
proprietary: all >rights reserved unauthorized (?:copying|use|reproduction) | this software is the >confidential and proprietary information of | no part of this (?:publication|book|document) may be >reproduced
beerware: you can do whatever you want with this stuff if we meet some day(?: [^ ]+){0,6} >beer
odbl: >opendatacommons org licenses odbl
odc-by: >opendatacommons org licenses by
json: the software shall be used for >good not evil
"""

#: The phrases that the base counts, with their labels.
BASE = [("mit", "mit >license"), ("apache", "apache >license"), ("gpl", "general public >license")]

_GRANT = ("(?:licensed|released|distributed|available|provided|published|covered|governed|offered|redistributable) "
          "(?:under|by|subject to) (?:the )?(?:terms (?:and conditions )?of )?(?:the )?")


class Rule(NamedTuple):
    order: int  # of the table; the first of equal detections stays
    keyword: str
    pattern: str  # over ' ' + words + ' ', with '>' before the keyword
    level: int
    label: str
    base: bool


def _cells(line: str, by: str) -> list[str]:
    return [cell.strip() for cell in line.split(by) if cell.strip()]


def rules() -> list[Rule]:
    """The whole table in its order: tags, sentences, notices, titles, names, then the base phrases."""
    found: list[tuple[int, str, str, bool]] = []
    for line in _cells(FAMILIES, "\n"):
        label, told = line.split(":", 1)
        titles, names, tags = told.split("||")
        for tag in _cells(tags, " | "):
            found.append((TAG, label, f"spdx license >identifier {tag}", False))
        for level, patterns in ((TITLE, titles), (NAME, names)):
            for pattern in _cells(patterns, " | "):
                found.append((level, label, f"(?:the )?(?:gnu )?{pattern}", False))
                found.append((NOTICE, label, f"{_GRANT}(?:gnu )?{pattern}", False))
    for line in _cells(SENTENCES, "\n"):
        label, told = line.split(":", 1)
        found += [(TEXT, label, pattern, False) for pattern in _cells(told, " | ")]
    found += [(NAME, label, pattern, True) for label, pattern in BASE]
    found.sort(key=lambda f: f[0])  # stable: the order written within a level
    out = []
    for order, (level, label, pattern, base) in enumerate(found):
        for short, form in _FORMS.items():
            pattern = pattern.replace(short, form)
        out.append(Rule(order, re.search(r">([a-z0-9]+)", pattern).group(1), f" {pattern} ", level, label, base))
    return out
