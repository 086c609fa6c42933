"""Signature rules for licences, as regular expressions over words.

A rule is matched against the lower-cased alphanumeric words of a text joined by one space, so
``Apache-2.0``, ``apache 2.0`` and a name that wraps over comment lines look alike. It stands for
whole words; ``( x)?`` is an optional word, ``[^ ]+`` any word. A rule's keyword is the longest
plain word outside its groups: every match holds it.

Levels are the order of the rules, the surest first. Within a level the longer match wins, then
the earlier rule.
"""

from __future__ import annotations

import re
from typing import NamedTuple

# Level of each kind of signature and how sure a detection of it is.
WEIGHTS = {"tag": 1.0, "text": 0.95, "url": 0.9, "name": 0.8, "family": 0.6, "hint": 0.3}
LEVELS = {kind: k for k, kind in enumerate(WEIGHTS)}

# Labels that a machine-readable tag may name; its rules are built from the label.
TAGGED = """
0bsd afl-2.1 afl-3.0 agpl-3.0 apache-1.1 apache-2.0 apsl-2.0 artistic-1.0 artistic-2.0 blueoak-1.0.0 bsd-2-clause bsd-3-clause
bsd-4-clause bsl-1.0 busl-1.1 bzip2-1.0.6 cc-by-1.0 cc-by-2.0 cc-by-2.5 cc-by-3.0 cc-by-4.0 cc-by-nc-2.0 cc-by-nc-2.5 cc-by-nc-3.0
cc-by-nc-4.0 cc-by-nc-nd-3.0 cc-by-nc-nd-4.0 cc-by-nc-sa-2.0 cc-by-nc-sa-3.0 cc-by-nc-sa-4.0 cc-by-nd-3.0 cc-by-nd-4.0 cc-by-sa-2.0
cc-by-sa-2.5 cc-by-sa-3.0 cc-by-sa-4.0 cc0-1.0 cddl-1.0 cddl-1.1 cecill-2.1 cpl-1.0 curl ecl-2.0 efl-2.0 elastic-2.0 epl-1.0 epl-2.0
eupl-1.1 eupl-1.2 fsl-1.1 ftl gfdl-1.2 gfdl-1.3 gpl-1.0 gpl-2.0 gpl-3.0 hpnd icu ijg ipl-1.0 isc json lgpl-2.0 lgpl-2.1 lgpl-3.0
libpng-2.0 lppl-1.3c mit mit-0 mpl-1.0 mpl-1.1 mpl-2.0 ms-pl ms-rl mulanpsl-2.0 ncsa odbl-1.0 odc-by-1.0 ofl-1.0 ofl-1.1 openssl
osl-2.1 osl-3.0 pddl-1.0 php-3.0 php-3.01 polyform-noncommercial-1.0.0 postgresql psf-2.0 python-2.0 qpl-1.0 ruby sleepycat
spl-1.0 sspl-1.0 tcl unicode-3.0 unlicense upl-1.0 vim w3c wtfpl x11 xnet zend-2.0 zlib zpl-2.1
"""

# label: rule; rule ... by kind. Rules of a line are tried in its order, lines in theirs.
NAMED = {
    "text": """
mit: permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files( the software)? to deal in the software without restriction; the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit-0: permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided
x11: except as contained in this notice the name( s)? of( the)?( [^ ]+){1,8} shall not be used in advertising or otherwise to promote the sale use or other dealings in this software
json: the software shall be used for good not evil
bsd: redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met; redistributions of source code must retain the above copyright notice; redistributions in binary form must reproduce the above copyright notice
bsd-3-clause: neither the names? of( the)?( [^ ]+){1,12} may be used to endorse or promote products derived from this software without specific prior written permission
bsd-4-clause: all advertising materials mentioning features or use of this software must display the following acknowledge?ment
apache-2.0: licensed under the apache license version 2 0( the license)? you may not use this file except in compliance with the license; unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
apache-1.1: the end user documentation included with the redistribution if any must include the following acknowledge?ment this product includes software developed by the apache software foundation
gpl-2.0: under the terms of the gnu general public license as published by the free software foundation (either )?version 2; under the terms of( the)? gnu general public license version 2 (only )?as published by the free software foundation; gnu general public license version 2 june 1991
gpl-3.0: under the terms of the gnu general public license as published by the free software foundation (either )?version 3; gnu general public license version 3 29 june 2007
gpl: this program is free software you can redistribute it and or modify it; you should have received a copy of the gnu general public license along with this( [^ ]+)?( program)?
lgpl-2.1: under the terms of the gnu lesser general public license as published by the free software foundation (either )?version 2 1; gnu lesser general public license version 2 1 february 1999
lgpl-2.0: under the terms of the gnu library general public license as published by the free software foundation (either )?version 2; gnu library general public license version 2 june 1991
lgpl-3.0: under the terms of the gnu lesser general public license as published by the free software foundation (either )?version 3; gnu lesser general public license version 3 29 june 2007
lgpl: this library is free software you can redistribute it and or modify it; you should have received a copy of the gnu (lesser|library) general public license along with this library
agpl-3.0: under the terms of the gnu affero general public license as published by the free software foundation (either )?version 3; gnu affero general public license version 3 19 november 2007
gfdl: permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
mpl-2.0: this source code form is subject to the terms of the mozilla public license v 2 0
mpl-1.1: the contents of this file are subject to the mozilla public license version 1 1
epl-2.0: this program and the accompanying materials are made available under the terms of the eclipse public license( v)? 2 0
epl-1.0: this program and the accompanying materials are made available under the terms of the eclipse public license v1 0
cddl: the contents of this file are subject to the terms of the common development and distribution license
isc: permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies
0bsd: permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is
hpnd: permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted
zlib: this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software; altered source versions must be plainly marked as such and must not be misrepresented as being the original software
unlicense: this is free and unencumbered software released into the public domain
wtfpl: do what the fuck you want to public license terms and conditions for copying distribution and modification
bsl-1.0: permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
ncsa: permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal with the software without restriction
ofl-1.1: this font software is licensed under the sil open font license version 1 1
artistic-2.0: everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed preamble this license establishes the terms under which a given free software package
cc0-1.0: to the extent possible under law( [^ ]+){1,12} has waived all copyright and related or neighboring rights
cc-by: this work is licensed under( a| the)? creative commons attribution
postgresql: permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
openssl: this product includes software developed by the openssl project for use in the openssl toolkit
php: this product includes php software freely available from
python: python software foundation license version 2; psf is making python available to licensee on an as is basis
busl-1.1: the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work
elastic-2.0: you may not provide the software to third parties as a hosted or managed service
sspl-1.0: if you make the functionality of the program or a modified version available to third parties as a service
unicode: permission is hereby granted free of charge to any person obtaining a copy of( the unicode)? data files and any associated documentation
upl-1.0: subject to the condition set forth below permission is hereby granted to any person obtaining a copy of this software associated documentation and or data
""",
    "url": """
mit: opensource org licenses?( license)? mit( license)?( php)?
apache-2.0: apache org licenses license 2 0( txt| html)?; opensource org licenses?( license)? apache 2 0
apache-1.1: apache org licenses license 1 1
gpl-2.0: gnu org licenses( old licenses)? gpl 2 0( [^ ]+)?; opensource org licenses gpl 2 0
gpl-3.0: gnu org licenses gpl 3 0( [^ ]+)?; opensource org licenses gpl 3 0
gpl: gnu org (copyleft|licenses) gpl( html| txt)?; www gnu org licenses
lgpl-2.1: gnu org licenses( old licenses)? lgpl 2 1( [^ ]+)?
lgpl-3.0: gnu org licenses lgpl 3 0( [^ ]+)?
lgpl: gnu org (copyleft|licenses) (lgpl|lesser)( html| txt)?
agpl-3.0: gnu org licenses agpl( 3 0)?( [^ ]+)?
gfdl: gnu org (copyleft|licenses) fdl( 1 [0-9])?( html| txt)?
bsd-2-clause: opensource org licenses?( license)? bsd 2 clause
bsd-3-clause: opensource org licenses?( license)? bsd 3 clause
bsd: opensource org licenses bsd license( php)?
mpl-2.0: mozilla org mpl 2 0; mozilla org( en us)? mpl 2 0
mpl-1.1: mozilla org mpl mpl 1 1( html| txt)?
epl-2.0: eclipse org legal epl( v)? ?2 0( html)?; eclipse org legal epl v20( html)?
epl-1.0: eclipse org legal epl v10( html)?
cc0-1.0: creativecommons org publicdomain zero 1 0
public-domain: creativecommons org (licenses|publicdomain) (publicdomain|mark)( 1 0)?
cc-by-4.0: creativecommons org licenses by 4 0
cc-by-3.0: creativecommons org licenses by 3 0
cc-by-2.5: creativecommons org licenses by 2 5
cc-by-2.0: creativecommons org licenses by 2 0
cc-by-sa-4.0: creativecommons org licenses by sa 4 0
cc-by-sa-3.0: creativecommons org licenses by sa 3 0
cc-by-sa-2.5: creativecommons org licenses by sa 2 5
cc-by-sa-2.0: creativecommons org licenses by sa 2 0
cc-by-nd-4.0: creativecommons org licenses by nd 4 0
cc-by-nd-3.0: creativecommons org licenses by nd 3 0
cc-by-nc-4.0: creativecommons org licenses by nc 4 0
cc-by-nc-3.0: creativecommons org licenses by nc 3 0
cc-by-nc-2.0: creativecommons org licenses by nc 2 0
cc-by-nc-sa-4.0: creativecommons org licenses by nc sa 4 0
cc-by-nc-sa-3.0: creativecommons org licenses by nc sa 3 0
cc-by-nc-nd-4.0: creativecommons org licenses by nc nd 4 0
cc-by-nc-nd-3.0: creativecommons org licenses by nc nd 3 0
odbl-1.0: opendatacommons org licenses odbl( 1 0| summary)?
odc-by-1.0: opendatacommons org licenses by( 1 0)?
pddl-1.0: opendatacommons org licenses pddl( 1 0)?
unlicense: unlicense org
wtfpl: wtfpl net
isc: opensource org licenses?( license)? isc( license)?( txt)?
zlib: zlib net zlib license( html)?; opensource org licenses zlib
ofl-1.1: scripts sil org ofl; opensource org licenses ofl 1 1
bsl-1.0: boost org license 1 0( txt)?
artistic-2.0: opensource org licenses artistic license 2 0( php)?; perlfoundation org artistic license 2 0
ms-pl: opensource org licenses ms pl( html)?
php-3.01: php net license 3 01( txt)?
cecill: cecill info licen[cs]es?
eupl-1.2: joinup ec europa eu( [^ ]+){1,6} eupl
elastic-2.0: elastic co licensing elastic license
sspl-1.0: mongodb com licensing server side public license
busl-1.1: mariadb com bsl11
blueoak-1.0.0: blueoakcouncil org license 1 0 0
""",
    "name": """
apache-2.0: apache( software)? licen[cs]e( version| v)? 2( 0)?; apache( software)? licen[cs]e v2( 0)?; apache 2 0( licen[cs]e)?; asl 2 0
apache-1.1: apache( software)? licen[cs]e( version| v)? 1 1
apache-1.0: apache( software)? licen[cs]e( version| v)? 1 0
gpl-1.0: gnu general public licen[cs]e( version| v)? v?1( 0)?; gpl v?1( 0)?
gpl-2.0: gnu general public licen[cs]e( version| v)? v?2( 0)?( only| or later)?; gnu gpl( version| v)? v?2( 0)?; gpl( version| v)? 2( 0)?( only| or later)?; gplv2
gpl-3.0: gnu general public licen[cs]e( version| v)? v?3( 0)?( only| or later)?; gnu gpl( version| v)? v?3( 0)?; gpl( version| v)? 3( 0)?( only| or later)?; gplv3
lgpl-2.0: gnu library general public licen[cs]e( version| v)? v?2( 0)?; lgpl( version| v)? 2 0
lgpl-2.1: gnu lesser general public licen[cs]e( version| v)? v?2 1( only| or later)?; lgpl( version| v)? 2 1( only| or later)?; lgplv2 1
lgpl-3.0: gnu lesser general public licen[cs]e( version| v)? v?3( 0)?( only| or later)?; lgpl( version| v)? 3( 0)?( only| or later)?; lgplv3
agpl-3.0: gnu affero general public licen[cs]e( version| v)? v?3( 0)?; affero gpl( version| v)? 3; agpl( version| v)? 3( 0)?( only| or later)?; agplv3
gfdl-1.2: gnu free documentation licen[cs]e( version| v)? 1 2
gfdl-1.3: gnu free documentation licen[cs]e( version| v)? 1 3
bsd-2-clause: (2|two) clause bsd( licen[cs]e)?; bsd (2|two) clause( licen[cs]e)?; simplified bsd licen[cs]e; freebsd licen[cs]e
bsd-3-clause: (3|three) clause bsd( licen[cs]e)?; bsd (3|three) clause( licen[cs]e)?; (new|modified|revised) bsd licen[cs]e
bsd-4-clause: (4|four) clause bsd( licen[cs]e)?; bsd (4|four) clause( licen[cs]e)?; original bsd licen[cs]e
0bsd: zero clause bsd( licen[cs]e)?; bsd zero clause( licen[cs]e)?
mit-0: mit no attribution( licen[cs]e)?
x11: x11 licen[cs]e; mit x11 licen[cs]e; x11 mit licen[cs]e
isc: isc licen[cs]e; internet systems consortium licen[cs]e
mpl-2.0: mozilla public licen[cs]e( version| v)? v?2( 0)?; mpl( version| v)? 2( 0)?
mpl-1.1: mozilla public licen[cs]e( version| v)? v?1 1; mpl( version| v)? 1 1
mpl-1.0: mozilla public licen[cs]e( version| v)? v?1 0
epl-2.0: eclipse public licen[cs]e( version| v)? v?2( 0)?; epl( version| v)? 2 0
epl-1.0: eclipse public licen[cs]e( version| v)? v?1( 0)?; epl( version| v)? 1 0
cddl-1.0: common development and distribution licen[cs]e( version| v)? 1 0; cddl( version| v)? 1 0
cddl-1.1: common development and distribution licen[cs]e( version| v)? 1 1; cddl( version| v)? 1 1
cpl-1.0: common public licen[cs]e( version| v)? 1 0
ipl-1.0: ibm public licen[cs]e( version| v)? 1 0
eupl-1.1: european union public licen[cs]e( version| v)? 1 1; eupl( version| v)? 1 1
eupl-1.2: european union public licen[cs]e( version| v)? 1 2; eupl( version| v)? 1 2
cecill-2.1: cecill( free software)?( licen[cs]e)?( agreement)?( version| v)? 2 1
artistic-2.0: artistic licen[cs]e( version| v)? 2( 0)?
artistic-1.0: artistic licen[cs]e( version| v)? 1( 0)?
bsl-1.0: boost software licen[cs]e( version| v)? 1 0; boost software licen[cs]e
busl-1.1: business source licen[cs]e( version| v)? 1 1
zlib: zlib licen[cs]e; zlib libpng licen[cs]e
libpng-2.0: png reference library licen[cs]e( version| v)? 2
ofl-1.1: sil open font licen[cs]e( version| v)? 1 1; ofl( version| v)? 1 1
ofl-1.0: sil open font licen[cs]e( version| v)? 1 0
postgresql: postgresql licen[cs]e
psf-2.0: python software foundation licen[cs]e( version| v)? 2
python: python software foundation licen[cs]e; psf licen[cs]e
php-3.01: php licen[cs]e( version| v)? 3 01
php-3.0: php licen[cs]e( version| v)? 3 0
ruby: ruby licen[cs]e
wtfpl: do what the fuck you want to public licen[cs]e; wtfpl( version| v)?( 2)?
unlicense: the unlicense; unlicense licen[cs]e
cc0-1.0: cc0( 1 0)?( universal)?; creative commons zero( v1 0| 1 0)?( universal)?
cc-by-1.0: creative commons attribution 1 0( generic)?; cc by 1 0
cc-by-2.0: creative commons attribution 2 0( generic)?; cc by 2 0
cc-by-2.5: creative commons attribution 2 5( generic)?; cc by 2 5
cc-by-3.0: creative commons attribution 3 0( unported)?; cc by 3 0
cc-by-4.0: creative commons attribution 4 0( international)?; cc by 4 0
cc-by-sa-2.0: creative commons attribution share ?alike 2 0; cc by sa 2 0
cc-by-sa-2.5: creative commons attribution share ?alike 2 5; cc by sa 2 5
cc-by-sa-3.0: creative commons attribution share ?alike 3 0( unported)?; cc by sa 3 0
cc-by-sa-4.0: creative commons attribution share ?alike 4 0( international)?; cc by sa 4 0
cc-by-nd-3.0: creative commons attribution no ?deriv(ative)?s? 3 0; cc by nd 3 0
cc-by-nd-4.0: creative commons attribution no ?deriv(ative)?s? 4 0; cc by nd 4 0
cc-by-nc-2.0: creative commons attribution non ?commercial 2 0; cc by nc 2 0
cc-by-nc-2.5: creative commons attribution non ?commercial 2 5; cc by nc 2 5
cc-by-nc-3.0: creative commons attribution non ?commercial 3 0( unported)?; cc by nc 3 0
cc-by-nc-4.0: creative commons attribution non ?commercial 4 0( international)?; cc by nc 4 0
cc-by-nc-sa-2.0: cc by nc sa 2 0
cc-by-nc-sa-3.0: creative commons attribution non ?commercial share ?alike 3 0; cc by nc sa 3 0
cc-by-nc-sa-4.0: creative commons attribution non ?commercial share ?alike 4 0; cc by nc sa 4 0
cc-by-nc-nd-3.0: creative commons attribution non ?commercial no ?deriv(ative)?s? 3 0; cc by nc nd 3 0
cc-by-nc-nd-4.0: creative commons attribution non ?commercial no ?deriv(ative)?s? 4 0; cc by nc nd 4 0
odbl-1.0: open database licen[cs]e( version| v)?( 1 0)?; odbl( version| v)? 1 0
odc-by-1.0: open data commons attribution licen[cs]e( version| v)?( 1 0)?
pddl-1.0: open data commons public domain dedication( and)? licen[cs]e
ms-pl: microsoft public licen[cs]e
ms-rl: microsoft reciprocal licen[cs]e
osl-3.0: open software licen[cs]e( version| v)? 3 0
afl-3.0: academic free licen[cs]e( version| v)? 3 0
ecl-2.0: educational community licen[cs]e( version| v)? 2 0
upl-1.0: universal permissive licen[cs]e( version| v)?( 1 0)?
lppl-1.3c: latex project public licen[cs]e( version| v)? 1 3c?
elastic-2.0: elastic licen[cs]e( version| v)? 2( 0)?; elastic licen[cs]e v2
sspl-1.0: server side public licen[cs]e( version| v)?( 1)?
mulanpsl-2.0: mulan permissive software licen[cs]e( version| v)? ?v?2
ncsa: university of illinois ncsa( open source)? licen[cs]e; ncsa open source licen[cs]e
w3c: w3c software( notice and)? licen[cs]e
vim: vim licen[cs]e
openssl: openssl licen[cs]e; openssl ssleay licen[cs]e
ftl: freetype( project)? licen[cs]e
ijg: independent jpeg group licen[cs]e
qpl-1.0: q public licen[cs]e( version| v)?( 1 0)?
zpl-2.1: zope public licen[cs]e( version| v)? 2 1
polyform-noncommercial-1.0.0: polyform noncommercial licen[cs]e( version| v)?( 1 0 0)?
openrail: openrail( m)?( licen[cs]e)?; creativeml open ?rail( m)?( licen[cs]e)?
llama: llama( [0-9]){0,2} community licen[cs]e( agreement)?
""",
    "family": """
gpl: gnu general public license
apache: apache license
cc-by: cc by
mit: mit license
gpl: gnu gpl; gnu public licen[cs]e; gpl licen[cs]ed?; general public licence
lgpl: gnu lgpl; gnu (lesser|library) general public licen[cs]e; lgpl licen[cs]ed?
agpl: gnu agpl; gnu affero general public licen[cs]e; affero general public licen[cs]e
gfdl: gnu free documentation licen[cs]e; gnu fdl
apache: apache licen[cs]ed; apache software licen[cs]e; apache style licen[cs]e; asf licen[cs]e
mit: mit licen[cs]ed; mit style licen[cs]e; expat licen[cs]e; the mit licence
bsd: bsd licen[cs]ed?; bsd style licen[cs]e; berkeley software distribution licen[cs]e
mpl: mozilla public licen[cs]e
epl: eclipse public licen[cs]e
cddl: common development and distribution licen[cs]e
eupl: european union public licen[cs]e
artistic: artistic licen[cs]e
cc-by: creative commons attribution( licen[cs]e)?
cc-by-sa: cc by sa; creative commons attribution share ?alike
cc-by-nc: cc by nc; creative commons attribution non ?commercial
cc-by-nd: cc by nd; creative commons attribution no ?deriv(ative)?s?
cc-by-nc-sa: cc by nc sa; creative commons attribution non ?commercial share ?alike
cc-by-nc-nd: cc by nc nd; creative commons attribution non ?commercial no ?deriv(ative)?s?
cc: creative commons licen[cs]ed?; creative commons; cc licen[cs]ed
ofl: open font licen[cs]e
php: php licen[cs]e
perl: same terms as perl( itself)?; perl licen[cs]e
public-domain: public domain dedication; (released|placed|dedicated) (into|in|to) the public domain
""",
    "hint": """
proprietary: all rights reserved; proprietary and confidential; unauthorized copying of this( [^ ]+){1,3} is( strictly)? prohibited; confidential and proprietary; trade secret( [^ ]+)? of( [^ ]+){1,3}; may not be reproduced( [^ ]+){0,6} without( [^ ]+){0,3} permission; end user licen[cs]e agreement
open-source: open source licen[cs]ed?; open source software licen[cs]e; osi approved( [^ ]+)? licen[cs]e; free software licen[cs]e
permissive: permissive licen[cs]e; permissively licen[cs]ed
copyleft: copyleft licen[cs]e; copyleft
non-commercial: (for )?non ?commercial use only; personal use only; academic use only; research purposes only
public-domain: in the public domain; no rights reserved; no known copyright restrictions
licence: licen[cs]ed under( the)?( terms of)?( the)?; see( the)?( file)? licen[cs]e( txt| md)? for( [^ ]+)? details; released under( the)?( [^ ]+){0,4} licen[cs]e; distributed under( the)?( [^ ]+){0,4} licen[cs]e; subject to( the)?( terms of)?( the| this)?( [^ ]+){0,3} licen[cs]e
""",
}

# The base phrases and their labels.
BASE = {
    "gpl": "gnu general public license",
    "apache": "apache license",
    "cc-by": "cc by",
    "mit": "mit license",
}


class Rule(NamedTuple):
    number: int  # place in the order
    kind: str
    label: str
    pattern: str
    keyword: str

    @property
    def base(self) -> bool:
        """A base phrase, every place of which counts."""
        return self.pattern == BASE.get(self.label)


def keyword(pattern: str) -> str:
    """The longest plain word outside the groups of a rule."""
    bare = pattern
    while (inner := re.sub(r"\([^()]*\)(\?|\{[^}]*\})?", " . ", bare)) != bare:
        bare = inner
    plain = [w for w in bare.split() if re.fullmatch("[0-9a-z]+", w)]
    # A word before " ?" may run on into the next one.
    joined = {x for a, b in re.findall(r"([^ ]+) \?([^ ]+)", bare) for x in (a, b)}
    return max((w for w in plain if w not in joined), key=len, default="")


def rules() -> list[Rule]:
    found: list[tuple[str, str, str]] = []
    for label in TAGGED.split():
        words = re.sub(r"[^0-9a-z]+", " ", label)
        found.append(("tag", label, f"spdx license identifier {words}( only| or later)?"))
        found.append(("tag", label, f"spdx id {words}( only| or later)?"))
    for kind, lines in NAMED.items():
        for line in lines.strip().splitlines():
            label, patterns = line.split(": ", 1)
            found += [(kind, label, p.strip()) for p in patterns.split(";")]
    return [Rule(n, kind, label, p, keyword(p)) for n, (kind, label, p) in enumerate(found)]


RULES = rules()
