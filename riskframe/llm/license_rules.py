"""License signatures: one rule a line, ``label | confidence % | regex``.

Regexes run over the folded words of a text joined by single spaces, so punctuation, case and
line breaks don't matter. A rule runs only on texts that hold the words of one of its alternatives,
which are taken from the regex itself. Rules under a smaller ``# level`` come first; within a level the
longer match does.
"""

import re
from re import _parser

RULES = r"""
# level 1: whole grants and warranty passages
mit | 99 | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | 97 | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit-0 | 98 | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided
x11 | 97 | except as contained in this notice the name of the x consortium shall not be used in advertising
isc | 98 | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice
0bsd | 98 | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided
bsd-2-clause | 90 | redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
bsd-3-clause | 98 | neither the names? of (?:\S+ ){1,12}?nor the names of (?:its|their) contributors may be used to endorse or promote products
bsd-4-clause | 98 | all advertising materials mentioning features or use of this software must display the following acknowledgement
apache-2.0 | 99 | licensed under the apache license version 2 0 the license you may not use this (?:file|software|work|project) except in compliance with the license
apache-2.0 | 95 | unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind
apache-1.1 | 97 | this product includes software developed by the apache software foundation
gpl-2.0-or-later | 99 | (?:this program|it) is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version
gpl-3.0-or-later | 99 | (?:this program|it) is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version
gpl-2.0 | 98 | you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation
gpl-3.0 | 98 | you can redistribute it and or modify it under the terms of the gnu general public license version 3 as published by the free software foundation
lgpl-2.1-or-later | 99 | you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version
lgpl-3.0-or-later | 99 | you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version
lgpl-2.0-or-later | 99 | you can redistribute it and or modify it under the terms of the gnu library general public license as published by the free software foundation either version 2 of the license or at your option any later version
agpl-3.0-or-later | 99 | you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version
gpl | 85 | this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license
gpl | 85 | you should have received a copy of the gnu general public license along with this (?:program|library|software|file)
lgpl | 85 | you should have received a copy of the gnu lesser general public license along with this (?:program|library|software|file)
agpl | 85 | you should have received a copy of the gnu affero general public license along with this (?:program|library|software|file)
mpl-2.0 | 99 | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-2.0 | 95 | if a copy of the mpl was not distributed with this file you can obtain one at https? mozilla org mpl 2 0
mpl-1.1 | 98 | the contents of this file are subject to the mozilla public license version 1 1
mpl-1.0 | 98 | the contents of this file are subject to the mozilla public license version 1 0
cddl-1.0 | 98 | the contents of this file are subject to the terms of the common development and distribution license
epl-2.0 | 98 | this program and the accompanying materials are made available under the terms of the eclipse public license (?:version |v ?)?2 0
epl-1.0 | 98 | this program and the accompanying materials are made available under the terms of the eclipse public license (?:version |v ?)?1 0
unlicense | 98 | this is free and unencumbered software released into the public domain
unlicense | 95 | anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary
zlib | 98 | the origin of this software must not be misrepresented you must not claim that you wrote the original software
zlib | 94 | altered source versions must be plainly marked as such and must not be misrepresented as being the original software
bsl-1.0 | 98 | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
wtfpl | 98 | everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed
wtfpl | 98 | you just do what the fuck you want to
beerware | 98 | if we meet some day and you think this stuff is worth it you can buy me a beer in return
postgresql | 97 | permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
curl | 96 | permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies
ntp | 95 | permission to use copy modify and distribute this software and its documentation for any purpose (?:with or without|and without) fee is hereby granted provided that
ofl-1.1 | 98 | the fonts and derivatives however cannot be released under any other type of license
ofl-1.1 | 97 | this font software is licensed under the sil open font license version 1 1
artistic-2.0 | 96 | this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed
upl-1.0 | 97 | subject to the condition set forth below permission is hereby granted to any person obtaining a copy of this software associated documentation and or data
ncsa | 95 | redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimers
cc0-1.0 | 97 | (?:the person who associated a work with this deed has )?dedicated the work to the public domain by waiving all of (?:his or her|their) rights
cc0-1.0 | 97 | to the extent possible under law (?:\S+ ){1,12}?has waived all copyright and related or neighboring rights
sspl-1.0 | 98 | this program is free software you can redistribute it and or modify it under the terms of the server side public license
busl-1.1 | 97 | the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work
elastic-2.0 | 97 | you may not provide the software to third parties as a hosted or managed service
commons-clause | 96 | the license does not grant to you the right to sell the software
json | 97 | the software shall be used for good not evil
openssl | 97 | this product includes software developed by the openssl project for use in the openssl toolkit
php-3.01 | 97 | this product includes php software freely available from
python-2.0 | 97 | this license agreement is between the python software foundation psf and the individual or organization
vim | 95 | there are no restrictions on distributing unmodified copies of vim
latex-1.3c | 97 | this work may be distributed and or modified under the conditions of the latex project public license
ms-pl | 96 | this license governs use of the accompanying software if you use the software you accept this license
proprietary | 90 | (?:this (?:software|document|code) (?:is|contains) )?(?:the )?(?:confidential and proprietary|proprietary and confidential) (?:information|property)
proprietary | 90 | unauthorized (?:copying|reproduction|distribution|use) (?:\S+ ){0,10}?is strictly prohibited
# level 2: names with a version
apache-2.0 | 95 | (?:the )?apache (?:software )?licen[sc]e (?:version |ver |v ?)?2(?: 0)?
apache-2.0 | 95 | apache 2(?: 0)? licen[sc]e
apache-2.0 | 90 | asl 2(?: 0)?
apache-1.1 | 95 | (?:the )?apache (?:software )?licen[sc]e (?:version |ver |v ?)?1 1
apache-1.0 | 93 | (?:the )?apache (?:software )?licen[sc]e (?:version |ver |v ?)?1(?: 0)?
gpl-1.0 | 93 | (?:gnu )?general public license (?:gpl )?(?:v |ver |version )1(?: 0)?
gpl-2.0 | 95 | (?:gnu )?general public license (?:gpl )?(?:version |ver |v ?)?2(?: 0)?
gpl-2.0-or-later | 96 | (?:gnu )?general public license (?:gpl )?(?:version |ver |v ?)?2(?: 0)? or (?:at your option )?(?:any )?later(?: version)?
gpl-3.0 | 95 | (?:gnu )?general public license (?:gpl )?(?:version |ver |v ?)?3(?: 0)?
gpl-3.0-or-later | 96 | (?:gnu )?general public license (?:gpl )?(?:version |ver |v ?)?3(?: 0)? or (?:at your option )?(?:any )?later(?: version)?
lgpl-2.0 | 95 | (?:gnu )?library general public license (?:lgpl )?(?:version |ver |v ?)?2(?: 0)?
lgpl-2.1 | 96 | (?:gnu )?lesser general public license (?:lgpl )?(?:version |ver |v ?)?2 1
lgpl-2.1-or-later | 97 | (?:gnu )?lesser general public license (?:lgpl )?(?:version |ver |v ?)?2 1 or (?:at your option )?(?:any )?later(?: version)?
lgpl-3.0 | 96 | (?:gnu )?lesser general public license (?:lgpl )?(?:version |ver |v ?)?3(?: 0)?
lgpl-3.0-or-later | 97 | (?:gnu )?lesser general public license (?:lgpl )?(?:version |ver |v ?)?3(?: 0)? or (?:at your option )?(?:any )?later(?: version)?
agpl-3.0 | 96 | (?:gnu )?affero general public license (?:agpl )?(?:version |ver |v ?)?3(?: 0)?
agpl-1.0 | 94 | affero general public license (?:version |ver |v ?)?1(?: 0)?
gfdl-1.1 | 95 | (?:gnu )?free documentation license (?:version |v ?)?1 1
gfdl-1.2 | 95 | (?:gnu )?free documentation license (?:version |v ?)?1 2
gfdl-1.3 | 95 | (?:gnu )?free documentation license (?:version |v ?)?1 3
gpl-2.0 | 90 | (?:gnu )?gplv2
gpl-3.0 | 90 | (?:gnu )?gplv3
lgpl-2.0 | 90 | (?:gnu )?lgplv2
lgpl-2.1 | 91 | (?:gnu )?lgplv2 1
lgpl-3.0 | 90 | (?:gnu )?lgplv3
agpl-3.0 | 90 | (?:gnu )?agplv3
gpl-2.0 | 88 | (?:gnu )?gpl (?:version |ver |v ?)?2(?: 0)?
gpl-3.0 | 88 | (?:gnu )?gpl (?:version |ver |v ?)?3(?: 0)?
lgpl-2.1 | 88 | (?:gnu )?lgpl (?:version |ver |v ?)?2 1
lgpl-3.0 | 88 | (?:gnu )?lgpl (?:version |ver |v ?)?3(?: 0)?
agpl-3.0 | 88 | (?:gnu )?agpl (?:version |ver |v ?)?3(?: 0)?
mpl-2.0 | 96 | mozilla public licen[sc]e (?:mpl )?(?:version |ver |v ?)?2(?: 0)?
mpl-1.1 | 96 | mozilla public licen[sc]e (?:mpl )?(?:version |ver |v ?)?1 1
mpl-1.0 | 95 | mozilla public licen[sc]e (?:mpl )?(?:version |ver |v ?)?1 0
mpl-2.0 | 88 | mpl (?:version |v ?)?2 0
epl-1.0 | 95 | eclipse public licen[sc]e (?:epl )?(?:version |ver |v ?)?1(?: 0)?
epl-2.0 | 96 | eclipse public licen[sc]e (?:epl )?(?:version |ver |v ?)?2(?: 0)?
edl-1.0 | 94 | eclipse distribution licen[sc]e (?:version |v ?)?1(?: 0)?
cddl-1.0 | 94 | cddl (?:version |v ?)?1(?: 0)?
cddl-1.1 | 95 | cddl (?:version |v ?)?1 1
cpl-1.0 | 94 | common public licen[sc]e (?:version |v ?)?1 0
eupl-1.1 | 95 | european union public licen[sc]e (?:eupl )?(?:version |v ?)?1 1
eupl-1.2 | 95 | european union public licen[sc]e (?:eupl )?(?:version |v ?)?1 2
osl-3.0 | 95 | open software licen[sc]e (?:osl )?(?:version |v ?)?3 0
afl-3.0 | 95 | academic free licen[sc]e (?:afl )?(?:version |v ?)?3 0
artistic-1.0 | 94 | artistic licen[sc]e (?:version |v ?)?1 0
artistic-2.0 | 95 | artistic licen[sc]e (?:version |v ?)?2 0
bsl-1.0 | 96 | boost software licen[sc]e (?:version |v ?)?1 0
ofl-1.1 | 95 | (?:sil )?open font licen[sc]e (?:version |v ?)?1 1
odbl-1.0 | 95 | open (?:data commons open )?database licen[sc]e (?:odbl )?(?:version |v ?)?1 0
odc-by-1.0 | 95 | open data commons attribution licen[sc]e (?:version |v ?)?1 0
pddl-1.0 | 95 | (?:open data commons )?public domain dedication and licen[sc]e(?: (?:version |v ?)?1 0)?
ecl-2.0 | 95 | educational community licen[sc]e (?:version |v ?)?2 0
upl-1.0 | 95 | universal permissive licen[sc]e (?:version |v ?)?1 0
sspl-1.0 | 95 | server side public licen[sc]e(?: (?:version |v ?)?1)?
busl-1.1 | 95 | business source licen[sc]e (?:version |v ?)?1 1
elastic-2.0 | 95 | elastic licen[sc]e (?:version |v ?)?2 0
zpl-2.1 | 95 | zope public licen[sc]e (?:version |v ?)?2 1
zpl-2.0 | 94 | zope public licen[sc]e (?:version |v ?)?2 0
php-3.01 | 95 | php licen[sc]e (?:version |v ?)?3 0?1
python-2.0 | 93 | python software foundation licen[sc]e (?:version |v ?)?2
qpl-1.0 | 94 | q public licen[sc]e (?:version |v ?)?1 0
ibm-1.0 | 94 | ibm public licen[sc]e (?:version |v ?)?1 0
lppl-1.3 | 95 | latex project public licen[sc]e (?:version |v ?)?1 3c?
unicode-dfs | 93 | unicode (?:data files and software )?licen[sc]e(?: agreement)?
cc-by-1.0 | 94 | (?:creative commons )?attribution 1 0 (?:generic|international|unported)
cc-by-2.0 | 94 | (?:creative commons )?attribution 2 0 (?:generic|international|unported)
cc-by-2.5 | 94 | (?:creative commons )?attribution 2 5 (?:generic|international|unported)
cc-by-3.0 | 95 | (?:creative commons )?attribution 3 0 (?:generic|international|unported)
cc-by-4.0 | 96 | (?:creative commons )?attribution 4 0 (?:generic|international|unported)
cc-by-sa-2.0 | 95 | (?:creative commons )?attribution sharealike 2 0
cc-by-sa-2.5 | 95 | (?:creative commons )?attribution sharealike 2 5
cc-by-sa-3.0 | 96 | (?:creative commons )?attribution sharealike 3 0
cc-by-sa-4.0 | 97 | (?:creative commons )?attribution sharealike 4 0
cc-by-nc-2.0 | 95 | (?:creative commons )?attribution noncommercial 2 0
cc-by-nc-3.0 | 95 | (?:creative commons )?attribution noncommercial 3 0
cc-by-nc-4.0 | 96 | (?:creative commons )?attribution noncommercial 4 0
cc-by-nd-3.0 | 95 | (?:creative commons )?attribution no ?derivatives? 3 0
cc-by-nd-4.0 | 96 | (?:creative commons )?attribution noderivatives 4 0
cc-by-nc-sa-3.0 | 96 | (?:creative commons )?attribution noncommercial sharealike 3 0
cc-by-nc-sa-4.0 | 97 | (?:creative commons )?attribution noncommercial sharealike 4 0
cc-by-nc-nd-3.0 | 96 | (?:creative commons )?attribution noncommercial noderivatives 3 0
cc-by-nc-nd-4.0 | 97 | (?:creative commons )?attribution noncommercial noderivatives 4 0
cc0-1.0 | 96 | cc0 (?:1 0|universal|public domain dedication)(?: universal)?
bsd-2-clause | 94 | (?:2|two) clause (?:free)?bsd(?: licen[sc]e)?
bsd-3-clause | 94 | (?:3|three) clause bsd(?: licen[sc]e)?
bsd-4-clause | 94 | (?:4|four) clause bsd(?: licen[sc]e)?
bsd-2-clause | 94 | bsd (?:2|two) clause(?: licen[sc]e)?
bsd-3-clause | 94 | bsd (?:3|three) clause(?: licen[sc]e)?
bsd-4-clause | 94 | bsd (?:4|four) clause(?: licen[sc]e)?
bsd-3-clause | 93 | (?:new|modified|revised) bsd(?: licen[sc]e)?
bsd-3-clause | 93 | (?:modified|revised) bsd(?: licen[sc]e)?
bsd-2-clause | 93 | simplified bsd(?: licen[sc]e)?
bsd-4-clause | 92 | original bsd(?: licen[sc]e)?
# level 3: machine-readable identifiers
spdx-mit | 99 | spdx license identifier mit
spdx-apache-2.0 | 99 | spdx license identifier apache 2 0
spdx-gpl-2.0-only | 99 | spdx license identifier gpl 2 0(?: only)?
spdx-gpl-2.0-or-later | 99 | spdx license identifier gpl 2 0 or later
spdx-gpl-3.0-only | 99 | spdx license identifier gpl 3 0(?: only)?
spdx-gpl-3.0-or-later | 99 | spdx license identifier gpl 3 0 or later
spdx-lgpl-2.1-only | 99 | spdx license identifier lgpl 2 1(?: only)?
spdx-lgpl-2.1-or-later | 99 | spdx license identifier lgpl 2 1 or later
spdx-lgpl-3.0-only | 99 | spdx license identifier lgpl 3 0(?: only)?
spdx-agpl-3.0-only | 99 | spdx license identifier agpl 3 0(?: only)?
spdx-agpl-3.0-or-later | 99 | spdx license identifier agpl 3 0 or later
spdx-mpl-2.0 | 99 | spdx license identifier mpl 2 0
spdx-epl-2.0 | 99 | spdx license identifier epl 2 0
spdx-bsd-2-clause | 99 | spdx license identifier bsd 2 clause
spdx-bsd-3-clause | 99 | spdx license identifier bsd 3 clause
spdx-isc | 99 | spdx license identifier isc
spdx-zlib | 99 | spdx license identifier zlib
spdx-unlicense | 99 | spdx license identifier unlicense
spdx-cc0-1.0 | 99 | spdx license identifier cc0 1 0
spdx-cc-by-4.0 | 99 | spdx license identifier cc by 4 0
spdx-cc-by-sa-4.0 | 99 | spdx license identifier cc by sa 4 0
spdx-bsl-1.0 | 99 | spdx license identifier bsl 1 0
spdx-0bsd | 99 | spdx license identifier 0bsd
spdx-other | 80 | spdx license identifier (?:licenseref )?\S+
# level 4: addresses
mit | 92 | opensource org licenses? mit(?: license)?
apache-2.0 | 96 | apache org licenses license 2 0
apache-1.1 | 94 | apache org licenses license 1 1
gpl-2.0 | 94 | gnu org licenses (?:old licenses )?gpl 2 0
gpl-3.0 | 94 | gnu org licenses gpl 3 0
gpl | 88 | gnu org (?:copyleft|licenses) gpl
lgpl-2.1 | 94 | gnu org licenses (?:old licenses )?lgpl 2 1
lgpl-3.0 | 94 | gnu org licenses lgpl 3 0
agpl-3.0 | 94 | gnu org licenses agpl 3 0
gfdl | 90 | gnu org (?:copyleft|licenses) fdl
mpl-2.0 | 94 | mozilla org mpl 2 0
mpl-1.1 | 93 | mozilla org mpl mpl 1 1
epl-1.0 | 94 | eclipse org legal epl v10
epl-2.0 | 94 | eclipse org (?:legal|org documents) epl (?:v20|2 0)
cc-by-4.0 | 95 | creativecommons org licenses by 4 0
cc-by-3.0 | 95 | creativecommons org licenses by 3 0
cc-by-sa-4.0 | 95 | creativecommons org licenses by sa 4 0
cc-by-sa-3.0 | 95 | creativecommons org licenses by sa 3 0
cc-by-nc-4.0 | 95 | creativecommons org licenses by nc 4 0
cc-by-nd-4.0 | 95 | creativecommons org licenses by nd 4 0
cc-by-nc-sa-4.0 | 95 | creativecommons org licenses by nc sa 4 0
cc-by-nc-nd-4.0 | 95 | creativecommons org licenses by nc nd 4 0
cc0-1.0 | 95 | creativecommons org publicdomain zero 1 0
cc-pdm-1.0 | 94 | creativecommons org publicdomain mark 1 0
bsl-1.0 | 94 | boost org license 1 0
unlicense | 94 | unlicense org
wtfpl | 93 | wtfpl net
isc | 92 | opensource org licenses? isc
bsd-2-clause | 92 | opensource org licenses? bsd 2 clause
bsd-3-clause | 92 | opensource org licenses? bsd 3 clause
artistic-2.0 | 92 | opensource org licenses? artistic 2 0
ofl-1.1 | 92 | scripts sil org ofl
# level 5: names without a version
mit | 90 | (?:licensed|released|distributed|available) under (?:the )?(?:terms of (?:the )?)?mit(?: licen[sc]e)?
mit | 85 | (?:the )?mit licen[sc]e
mit | 84 | (?:mit expat|expat mit|expat) licen[sc]e
x11 | 84 | (?:the )?(?:mit )?x11 licen[sc]e
apache | 85 | (?:licensed|released|distributed|available) under (?:the )?(?:terms of (?:the )?)?apache licen[sc]e
apache | 80 | (?:the )?apache (?:software )?licen[sc]e
gpl | 85 | (?:licensed|released|distributed|available) under (?:the )?(?:terms of (?:the )?)?(?:gnu )?general public licen[sc]e
gpl | 80 | (?:the )?(?:gnu )?general public licen[sc]e
gpl | 75 | (?:licensed|released|distributed|available) under (?:the )?(?:gnu )?gpl
lgpl | 82 | (?:the )?(?:gnu )?lesser general public licen[sc]e
lgpl | 82 | (?:the )?(?:gnu )?library general public licen[sc]e
lgpl | 75 | (?:gnu )?lgpl
agpl | 82 | (?:the )?(?:gnu )?affero general public licen[sc]e
agpl | 75 | (?:gnu )?agpl
gfdl | 80 | (?:gnu )?free documentation licen[sc]e
bsd | 78 | (?:the )?(?:berkeley )?bsd (?:style )?licen[sc]e
bsd | 78 | berkeley software distribution licen[sc]e
isc | 80 | (?:the )?isc licen[sc]e
zlib | 78 | (?:the )?zlib(?: libpng)? licen[sc]e
mpl | 80 | mozilla public licen[sc]e
epl | 80 | eclipse public licen[sc]e
cddl | 80 | common development and distribution licen[sc]e
cpl | 76 | common public licen[sc]e
eupl | 80 | european union public licen[sc]e
osl | 76 | open software licen[sc]e
afl | 76 | academic free licen[sc]e
artistic | 78 | (?:perl )?artistic licen[sc]e
bsl | 80 | boost software licen[sc]e
ofl | 80 | (?:sil )?open font licen[sc]e
odbl | 80 | open database licen[sc]e
unlicense | 80 | the unlicense
wtfpl | 80 | (?:the )?wtfpl
beerware | 80 | (?:the )?beerware licen[sc]e
python | 76 | (?:python software foundation|psf) licen[sc]e
php | 74 | php licen[sc]e
ruby | 74 | (?:the )?ruby licen[sc]e
openssl | 78 | openssl licen[sc]e
vim | 74 | vim licen[sc]e
zope | 76 | zope public licen[sc]e
lppl | 78 | latex project public licen[sc]e
ms-pl | 78 | microsoft public licen[sc]e
ms-rl | 78 | microsoft reciprocal licen[sc]e
ncsa | 78 | (?:university of illinois )?ncsa open source licen[sc]e
postgresql | 78 | postgresql licen[sc]e
intel | 74 | intel open source licen[sc]e
nasa | 74 | nasa open source agreement
sun | 72 | sun (?:public|industry standards source) licen[sc]e
apsl | 76 | apple public source licen[sc]e
elastic | 76 | elastic licen[sc]e
busl | 78 | business source licen[sc]e
commons-clause | 78 | commons clause
creative-commons | 74 | creative commons(?: attribution)?(?: licen[sc]e)?
cc-by | 78 | cc by(?: \d \d)?
cc-by-sa | 80 | cc by sa(?: \d \d)?
cc-by-nc | 80 | cc by nc(?: \d \d)?
cc-by-nd | 80 | cc by nd(?: \d \d)?
cc-by-nc-sa | 82 | cc by nc sa(?: \d \d)?
cc-by-nc-nd | 82 | cc by nc nd(?: \d \d)?
cc0 | 80 | cc0
# level 6: loose references
public-domain | 60 | (?:released |placed |dedicated )(?:in|into|to) the public domain
public-domain | 55 | (?:is|are) in the public domain
dual | 60 | dual licensed(?: under)?
proprietary | 50 | all rights reserved
see-license | 40 | see (?:the )?(?:accompanying )?licen[sc]e file(?: for details)?
see-license | 40 | see (?:the )?(?:file )?copying(?: file)?
open-source | 30 | (?:an )?open source licen[sc]e
free-software | 30 | free software licen[sc]e
"""


def parse(text: str = RULES) -> list[tuple[int, str, float, bytes]]:
    """(level, label, confidence, regex) of every rule, in order."""
    out, level = [], 0
    for line in text.strip().splitlines():
        if line.startswith("# level"):
            level = int(line.split()[2].rstrip(":"))
        elif line.strip():
            label, sure, regex = (x.strip() for x in line.split("|", 2))
            re.compile(regex)
            out.append((level, label, int(sure) / 100, regex.encode()))
    return out


#: More alternatives of one part of a rule aren't told apart: the part then asks for no word.
ALTERNATIVES = 512


def _letters(tree) -> list[list[str | None]]:
    """The alternatives of a parsed regex as fixed letters; None where letters vary."""
    out: list[list[str | None]] = [[]]
    for kind, arg in tree:
        name = str(kind)
        if name == "LITERAL":
            some = [[chr(arg)]]
        elif name == "SUBPATTERN":
            some = _letters(arg[-1])
        elif name == "BRANCH":
            some = [x for alternative in arg[1] for x in _letters(alternative)]
        elif name in ("MAX_REPEAT", "MIN_REPEAT") and arg[:2] == (0, 1):
            some = [[], *_letters(arg[2])]
        else:
            some = [[None]]
        if len(out) * len(some) > ALTERNATIVES:
            some = [[None]]
        out = [x + y for x in out for y in some]
    return out


def keywords(regex: bytes) -> set[frozenset[bytes]]:
    """For each alternative of a rule the whole words that every match of it holds.

    A text without all the words of any of these sets has no match; an empty set asks for nothing.
    """
    sets = set()
    for letters in _letters(_parser.parse(regex.decode())):
        words = "".join("\0" if c is None else c for c in letters).split(" ")
        sets.add(frozenset(w.encode() for w in words if w and "\0" not in w))
    return {s for s in sets if not any(t < s for t in sets)}
