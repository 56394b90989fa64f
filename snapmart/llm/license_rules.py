"""Signatures of licences and rights notices, on normalised words.

The text a signature sees is lower case words with one space between them and one
at either end, so ``GPL-3.0+`` reads ``gpl 3 0``. A signature is a label, a priority,
a keyword that begins at a word of every text its pattern matches, and a pattern of whole words. Priorities:
5 tags and full names with a version, 4 short names with a version or a quoted
passage of the licence, 3 names without a version, 2 addresses, 1 general notices.
"""

from __future__ import annotations

from dataclasses import dataclass

#: Identifiers whose tag ("SPDX-License-Identifier: ...") is a signature of its own.
TAGGED = """
0BSD AFL-3.0 AGPL-1.0 AGPL-3.0-only AGPL-3.0-or-later AGPL-3.0 Apache-1.0 Apache-1.1 Apache-2.0 APSL-2.0 Artistic-1.0 Artistic-2.0
BlueOak-1.0.0 BSD-1-Clause BSD-2-Clause BSD-3-Clause BSD-3-Clause-Clear BSD-4-Clause BSL-1.0 BUSL-1.1 CC-BY-1.0 CC-BY-2.0 CC-BY-2.5 CC-BY-3.0 CC-BY-4.0
CC-BY-NC-2.0 CC-BY-NC-3.0 CC-BY-NC-4.0 CC-BY-NC-ND-3.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-3.0 CC-BY-NC-SA-4.0 CC-BY-ND-3.0 CC-BY-ND-4.0 CC-BY-SA-2.0
CC-BY-SA-3.0 CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 CDDL-1.1 CECILL-2.1 CPL-1.0 ECL-2.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2 GFDL-1.2 GFDL-1.3 GPL-1.0 GPL-2.0-only
GPL-2.0-or-later GPL-2.0 GPL-3.0-only GPL-3.0-or-later GPL-3.0 HPND ISC LGPL-2.0 LGPL-2.1-only LGPL-2.1-or-later LGPL-2.1 LGPL-3.0-only LGPL-3.0-or-later
LGPL-3.0 LPPL-1.3c MIT-0 MIT MPL-1.0 MPL-1.1 MPL-2.0 MS-PL MS-RL MulanPSL-2.0 NCSA ODbL-1.0 OFL-1.1 OSL-3.0 PDDL-1.0 PHP-3.01 PostgreSQL PSF-2.0
Python-2.0 QPL-1.0 Ruby Sleepycat SSPL-1.0 Unicode-DFS-2016 Unlicense UPL-1.0 Vim W3C WTFPL X11 Zlib ZPL-2.1
""".split()

#: label | priority | keyword | pattern
_RULES = r"""
gpl | 3 | general public license | (?:gnu )?general public license
gpl-1.0 | 5 | general public license | (?:gnu )?general public license (?:as published by the free software foundation )?(?:version |v )?1(?: 0)?
gpl-2.0 | 5 | general public license | (?:gnu )?general public license (?:as published by the free software foundation )?(?:either )?(?:version |v )?2(?: 0)?
gpl-3.0 | 5 | general public license | (?:gnu )?general public license (?:as published by the free software foundation )?(?:either )?(?:version |v )?3(?: 0)?
gpl-2.0-or-later | 5 | general public license | general public license (?:as published by the free software foundation )?(?:either )?(?:version |v )?2(?: 0)? (?:of the license )?or (?:at your option )?any later version
gpl-3.0-or-later | 5 | general public license | general public license (?:as published by the free software foundation )?(?:either )?(?:version |v )?3(?: 0)? (?:of the license )?or (?:at your option )?any later version
gpl | 3 | gnu gpl | gnu gpl
gpl-1.0 | 4 | gpl | (?:gnu )?gpl ?(?:version |v )?1(?: 0)?
gpl-2.0 | 4 | gpl | (?:gnu )?gpl ?(?:version |v )?2(?: 0)?
gpl-3.0 | 4 | gpl | (?:gnu )?gpl ?(?:version |v )?3(?: 0)?
gpl-2.0 | 4 | gplv2 | (?:gnu )?gplv2
gpl-3.0 | 4 | gplv3 | (?:gnu )?gplv3
gpl-2.0-or-later | 4 | gplv2 | gplv2 or (?:any )?later
gpl-3.0-or-later | 4 | gplv3 | gplv3 or (?:any )?later
gpl | 2 | licenses gpl | gnu org licenses (?:old licenses )?gpl(?: \d(?: \d)?)?(?: html| txt)?
gpl | 3 | licensed under the gpl | licensed under the gpl
gpl | 4 | take away your freedom | the licenses for most software are designed to take away your freedom
gpl | 4 | redistribute it | you can redistribute it and or modify it under the terms of the gnu general public license
lgpl | 3 | lesser general public license | (?:gnu )?lesser general public license
lgpl | 3 | library general public license | (?:gnu )?library general public license
lgpl-2.0 | 5 | library general public license | library general public license (?:version |v )?2(?: 0)?
lgpl-2.1 | 5 | lesser general public license | lesser general public license (?:as published by the free software foundation )?(?:either )?(?:version |v )?2 1
lgpl-3.0 | 5 | lesser general public license | lesser general public license (?:as published by the free software foundation )?(?:either )?(?:version |v )?3(?: 0)?
lgpl-2.1 | 4 | lgpl | lgpl ?(?:version |v )?2 1
lgpl-3.0 | 4 | lgpl | lgpl ?(?:version |v )?3(?: 0)?
lgpl-3.0 | 4 | lgplv3 | lgplv3
lgpl-2.1 | 4 | lgplv2 | lgplv2 1
lgpl | 3 | gnu lgpl | gnu lgpl
lgpl | 2 | licenses lgpl | gnu org licenses (?:old licenses )?lgpl(?: \d(?: \d)?)?(?: html| txt)?
agpl | 3 | affero general public license | (?:gnu )?affero general public license
agpl-1.0 | 5 | affero general public license | affero general public license (?:version |v )?1(?: 0)?
agpl-3.0 | 5 | affero general public license | affero general public license (?:as published by the free software foundation )?(?:either )?(?:version |v )?3(?: 0)?
agpl-3.0 | 4 | agpl | agpl ?(?:version |v )?3(?: 0)?
agpl-3.0 | 4 | agplv3 | agplv3
agpl | 3 | gnu agpl | gnu agpl
agpl | 2 | licenses agpl | gnu org licenses agpl(?: \d(?: \d)?)?(?: html| txt)?
gfdl | 3 | free documentation license | (?:gnu )?free documentation license
gfdl-1.2 | 5 | free documentation license | free documentation license (?:version |v )?1 2
gfdl-1.3 | 5 | free documentation license | free documentation license (?:version |v )?1 3
gfdl | 2 | licenses fdl | gnu org licenses fdl
apache-1.0 | 5 | apache | apache (?:software )?license (?:version |v )?1 0
apache-1.1 | 5 | apache | apache (?:software )?license (?:version |v )?1 1
apache-2.0 | 5 | apache | apache (?:software )?license (?:version |v )?2(?: 0)?
apache-2.0 | 4 | apache | apache 2(?: 0)?(?: license)?
apache-2.0 | 4 | apache | apache v2
apache | 3 | apache | apache (?:software )?license
apache-2.0 | 2 | licenses license 2 | apache org licenses license 2 0(?: html| txt)?
apache-2.0 | 4 | as is basis | distributed on an as is basis without warranties or conditions of any kind
apache-2.0 | 4 | in compliance with the license | you may not use this file except in compliance with the license
mit | 3 | mit license | (?:the )?mit license
mit | 3 | mit licence | (?:the )?mit licence
mit | 3 | licensed under mit | licensed under mit
mit | 3 | expat license | expat license
mit | 4 | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | 4 | substantial portions | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit | 4 | merchantability | the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement
mit | 2 | licenses mit | opensource org licenses mit(?: license)?(?: php| html)?
mit-0 | 4 | no attribution | mit no attribution
x11 | 3 | x11 license | x11 license
bsd | 3 | bsd | bsd (?:style )?licen[cs]e
bsd | 3 | berkeley software distribution | berkeley software distribution
bsd-1-clause | 5 | bsd | (?:bsd 1 clause|1 clause bsd|one clause bsd)(?: license)?
bsd-2-clause | 5 | bsd | (?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd)(?: license)?
bsd-2-clause | 5 | freebsd | freebsd(?: license)?
bsd-3-clause | 5 | bsd | (?:bsd 3 clause|3 clause bsd|three clause bsd|modified bsd|new bsd|revised bsd)(?: license)?
bsd-4-clause | 5 | bsd | (?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd)(?: license)?
0bsd | 5 | bsd | (?:zero clause bsd|bsd zero clause|0 clause bsd)(?: license)?
bsd | 4 | source and binary forms | redistribution and use in source and binary forms with or without modification are permitted
bsd-3-clause | 4 | endorse or promote | may be used to endorse or promote products derived from this software without specific prior written permission
bsd-4-clause | 4 | advertising materials | all advertising materials mentioning features or use of this software must display
bsd-2-clause | 2 | licenses bsd | opensource org licenses bsd 2 clause
bsd-3-clause | 2 | licenses bsd | opensource org licenses bsd 3 clause
isc | 3 | isc license | isc license
isc | 4 | permission to use copy | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
zlib | 3 | zlib | zlib (?:libpng )?license
zlib | 4 | misrepresented | the origin of this software must not be misrepresented
unlicense | 3 | unlicense | (?:the )?unlicense
unlicense | 4 | unencumbered | free and unencumbered software released into the public domain
unlicense | 2 | unlicense org | unlicense org
mpl | 3 | mozilla public license | mozilla public license
mpl-1.0 | 5 | mozilla public license | mozilla public license (?:version |v )?1 0
mpl-1.1 | 5 | mozilla public license | mozilla public license (?:version |v )?1 1
mpl-2.0 | 5 | mozilla public license | mozilla public license (?:version |v )?2(?: 0)?
mpl-1.1 | 4 | mpl | mpl ?(?:version |v )?1 1
mpl-2.0 | 4 | mpl | mpl ?(?:version |v )?2(?: 0)?
mpl | 2 | mozilla org mpl | mozilla org mpl(?: 2 0)?
epl | 3 | eclipse public license | eclipse public license
epl-1.0 | 5 | eclipse public license | eclipse public license (?:version |v )?1(?: 0)?
epl-2.0 | 5 | eclipse public license | eclipse public license (?:version |v )?2(?: 0)?
epl-1.0 | 4 | epl | epl ?(?:version |v )?1 0
epl-2.0 | 4 | epl | epl ?(?:version |v )?2 0
edl-1.0 | 3 | eclipse distribution license | eclipse distribution license
cpl-1.0 | 3 | common public license | common public license
cddl | 3 | common development and distribution license | common development and distribution license
cddl-1.0 | 5 | common development and distribution license | common development and distribution license (?:cddl )?(?:version |v )?1 0
cddl-1.1 | 5 | common development and distribution license | common development and distribution license (?:cddl )?(?:version |v )?1 1
eupl | 3 | european union public licen | european union public licen[cs]e
eupl-1.1 | 5 | european union public licen | european union public licen[cs]e (?:eupl )?(?:version |v )?1 1
eupl-1.2 | 5 | european union public licen | european union public licen[cs]e (?:eupl )?(?:version |v )?1 2
artistic | 3 | artistic license | artistic license
artistic-1.0 | 5 | artistic license | artistic license (?:version |v )?1(?: 0)?
artistic-2.0 | 5 | artistic license | artistic license (?:version |v )?2(?: 0)?
boost-1.0 | 3 | boost software license | boost software license(?: (?:version )?1 0)?
busl-1.1 | 3 | business source license | business source license(?: (?:version )?1 1)?
sspl-1.0 | 3 | server side public license | server side public license(?: (?:version )?1)?
elastic-2.0 | 3 | elastic license | elastic license(?: (?:version )?2(?: 0)?)?
commons-clause | 3 | commons clause | commons clause(?: license condition)?
afl-3.0 | 3 | academic free license | academic free license(?: (?:version |v )?3(?: 0)?)?
osl-3.0 | 3 | open software license | open software license(?: (?:version |v )?3(?: 0)?)?
ms-pl | 3 | microsoft public license | microsoft public license(?: ms pl)?
ms-rl | 3 | microsoft reciprocal license | microsoft reciprocal license(?: ms rl)?
ncsa | 3 | illinois | university of illinois ncsa open source license
ofl-1.1 | 3 | open font license | (?:sil )?open font license(?: (?:version )?1 1)?
psf-2.0 | 3 | python software foundation license | python software foundation license(?: (?:version )?2)?
php-3.01 | 3 | php license | php license(?: (?:version )?3 01)?
ruby | 3 | ruby license | ruby license
postgresql | 3 | postgresql license | postgresql license
openssl | 3 | openssl license | openssl license
qpl-1.0 | 3 | q public license | q public license
sleepycat | 3 | sleepycat | sleepycat license
w3c | 3 | w3c software | w3c software (?:notice and )?license
wtfpl | 3 | what the fuck you want | do what the fuck you want to public license
wtfpl | 4 | wtfpl | wtfpl
vim | 3 | vim license | vim license
upl-1.0 | 3 | universal permissive license | universal permissive license
ecl-2.0 | 3 | educational community license | educational community license
lppl-1.3c | 3 | latex project public license | latex project public license
mulanpsl-2.0 | 3 | mulan | mulan permissive software license
cecill-2.1 | 3 | cecill | cecill(?: free software)? license
blueoak-1.0.0 | 3 | blue oak | blue oak model license
hpnd | 3 | historical permission notice | historical permission notice and disclaimer
beerware | 3 | beer ware | beer ware license
zpl-2.1 | 3 | zope public license | zope public license
cc | 3 | creative commons | creative commons(?: public)? licen[cs]e
cc | 3 | creative commons | (?:under|by) (?:a |the )?creative commons
cc-by | 3 | cc by | cc by
cc-by-1.0 | 4 | cc by | cc by (?:v )?1(?: 0)?
cc-by-2.0 | 4 | cc by | cc by (?:v )?2(?: 0)?
cc-by-2.5 | 4 | cc by | cc by (?:v )?2 5
cc-by-3.0 | 4 | cc by | cc by (?:v )?3(?: 0)?
cc-by-4.0 | 4 | cc by | cc by (?:v )?4(?: 0)?
cc-by-sa | 4 | cc by sa | cc by sa
cc-by-sa-2.0 | 5 | cc by sa | cc by sa (?:v )?2(?: 0)?
cc-by-sa-2.5 | 5 | cc by sa | cc by sa (?:v )?2 5
cc-by-sa-3.0 | 5 | cc by sa | cc by sa (?:v )?3(?: 0)?
cc-by-sa-4.0 | 5 | cc by sa | cc by sa (?:v )?4(?: 0)?
cc-by-nd | 4 | cc by nd | cc by nd
cc-by-nd-3.0 | 5 | cc by nd | cc by nd (?:v )?3(?: 0)?
cc-by-nd-4.0 | 5 | cc by nd | cc by nd (?:v )?4(?: 0)?
cc-by-nc | 4 | cc by nc | cc by nc
cc-by-nc-2.0 | 5 | cc by nc | cc by nc (?:v )?2(?: 0)?
cc-by-nc-3.0 | 5 | cc by nc | cc by nc (?:v )?3(?: 0)?
cc-by-nc-4.0 | 5 | cc by nc | cc by nc (?:v )?4(?: 0)?
cc-by-nc-sa | 4 | cc by nc sa | cc by nc sa
cc-by-nc-sa-3.0 | 5 | cc by nc sa | cc by nc sa (?:v )?3(?: 0)?
cc-by-nc-sa-4.0 | 5 | cc by nc sa | cc by nc sa (?:v )?4(?: 0)?
cc-by-nc-nd | 4 | cc by nc nd | cc by nc nd
cc-by-nc-nd-3.0 | 5 | cc by nc nd | cc by nc nd (?:v )?3(?: 0)?
cc-by-nc-nd-4.0 | 5 | cc by nc nd | cc by nc nd (?:v )?4(?: 0)?
cc-by | 3 | creative commons attribution | creative commons attribution
cc-by-3.0 | 5 | creative commons attribution | creative commons attribution 3 0(?: unported| international)?(?: licen[cs]e)?
cc-by-4.0 | 5 | creative commons attribution | creative commons attribution 4 0(?: international)?(?: licen[cs]e)?
cc-by-sa | 4 | creative commons attribution | creative commons attribution share ?alike
cc-by-sa-3.0 | 5 | creative commons attribution | creative commons attribution share ?alike 3 0(?: unported)?
cc-by-sa-4.0 | 5 | creative commons attribution | creative commons attribution share ?alike 4 0(?: international)?
cc-by-nd | 4 | creative commons attribution | creative commons attribution no ?deriv(?:ative)?s
cc-by-nc | 4 | creative commons attribution | creative commons attribution non ?commercial
cc-by-nc-4.0 | 5 | creative commons attribution | creative commons attribution non ?commercial 4 0(?: international)?
cc-by-nc-sa | 4 | creative commons attribution | creative commons attribution non ?commercial share ?alike
cc-by-nc-sa-4.0 | 5 | creative commons attribution | creative commons attribution non ?commercial share ?alike 4 0(?: international)?
cc-by-nc-nd | 4 | creative commons attribution | creative commons attribution non ?commercial no ?deriv(?:ative)?s
cc-by-nc-nd-4.0 | 5 | creative commons attribution | creative commons attribution non ?commercial no ?deriv(?:ative)?s 4 0(?: international)?
cc-by | 2 | creativecommons org | creativecommons org licenses by(?: \d \d)?
cc-by-sa | 2 | creativecommons org | creativecommons org licenses by sa(?: \d \d)?
cc-by-nd | 2 | creativecommons org | creativecommons org licenses by nd(?: \d \d)?
cc-by-nc | 2 | creativecommons org | creativecommons org licenses by nc(?: \d \d)?
cc-by-nc-sa | 2 | creativecommons org | creativecommons org licenses by nc sa(?: \d \d)?
cc-by-nc-nd | 2 | creativecommons org | creativecommons org licenses by nc nd(?: \d \d)?
cc0-1.0 | 4 | cc0 | cc0(?: 1 0)?(?: universal)?
cc0-1.0 | 3 | creative commons zero | creative commons zero
cc0-1.0 | 2 | creativecommons org | creativecommons org publicdomain zero(?: 1 0)?
odbl-1.0 | 3 | open database licen | open database licen[cs]e
odc-by-1.0 | 3 | open data commons attribution | open data commons attribution licen[cs]e
pddl-1.0 | 3 | public domain dedication and licen | public domain dedication and licen[cs]e
ogl | 3 | open government licen | open government licen[cs]e(?: (?:version |v )?\d(?: \d)?)?
public-domain | 3 | public domain | (?:in|into|to) the public domain
public-domain | 3 | public domain | public domain (?:work|mark|dedication)
reserved | 1 | rights reserved | all rights reserved
some-rights-reserved | 1 | rights reserved | some rights reserved
no-rights-reserved | 1 | rights reserved | no rights reserved
reserved | 1 | alle rechte vorbehalten | alle rechte vorbehalten
reserved | 1 | tous droits r | tous droits réservés
reserved | 1 | todos los derechos reservados | todos los derechos reservados
copyright | 1 | copyright | copyright(?: c)? (?:19|20)\d\d
copyright | 1 | copyrighted | copyrighted (?:material|work)
proprietary | 1 | confidential | proprietary and confidential
proprietary | 1 | unauthorized | unauthorized (?:copying|reproduction|distribution|use) (?:of this file |of this document )?(?:via any medium )?is strictly prohibited
no-redistribution | 1 | written permission | may not be reproduced (?:or distributed )?without (?:prior )?written permission
non-commercial | 1 | commercial use | (?:for )?non commercial use only
non-commercial | 1 | noncommercial use | (?:for )?noncommercial use only
non-commercial | 1 | commercial purposes | for non commercial purposes(?: only)?
non-commercial | 1 | noncommercial purposes | for noncommercial purposes(?: only)?
license-notice | 1 | licensed under | licensed under(?: the terms of)?
license-notice | 1 | license agreement | (?:end user )?license agreement
license-notice | 1 | terms of the license | under the terms of the license
no-warranty | 1 | warranty | without (?:any )?warranty(?: of any kind)?
"""


@dataclass(frozen=True)
class Signature:
    label: str
    priority: int
    keyword: str
    pattern: str


def _words(identifier: str) -> str:
    return "".join(c if c.isalnum() else " " for c in identifier.lower())


def signatures() -> list[Signature]:
    out = []
    for line in _RULES.strip().splitlines():
        label, priority, keyword, pattern = (x.strip() for x in line.split(" | "))
        out.append(Signature(label, int(priority), keyword, pattern))
    tags = [Signature(t.lower(), 5, "spdx", f"spdx license identifier {_words(t)}") for t in TAGGED]
    return out + tags


#: Phrases whose places are counted, and their labels, in this order.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
