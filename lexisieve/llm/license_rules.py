"""Signature rules of the license scan.

One rule a line: label; priority (1-99); keywords; pattern. Patterns are regular
expressions over a text's lower-case words joined by single spaces, matched at
word borders. Every match contains one of the keywords (``a|b``) as a whole
word; a rule is tried only on texts that have one. Higher priorities win over contained detections.
"""

RULES = r"""
apache-2.0; 90; apache; (?:licensed|released|distributed|available) under (?:the )?(?:terms of the )?apache license,? version 2 0
apache-2.0; 85; apache; apache license version 2(?: 0)?
apache-2.0; 85; apache; apache software license version 2(?: 0)?
apache-2.0; 80; apache; apache license 2 0
apache-2.0; 80; apache; apache (?:license )?v2(?: 0)?
apache-2.0; 80; apache; apache 2 0 (?:license|licence)
apache-2.0; 90; apache; spdx license identifier apache 2 0
apache-2.0; 88; apache; www apache org licenses license 2 0
apache-1.1; 85; apache; apache software license version 1 1
apache-1.0; 85; apache; apache software license version 1 0
apache-1.1; 90; apache; spdx license identifier apache 1 1
apache; 40; apache; (?:under|with) (?:the |an )?apache (?:style )?licen[sc]e
apache; 35; apache; apache licen[sc]e
mit; 90; mit; (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of the )?mit(?: x11)? licen[sc]e
mit; 90; mit; spdx license identifier mit
mit; 75; mit; mit x11 licen[sc]e
mit; 70; mit; (?:the )?mit licen[sc]e(?: mit)?
mit; 85; hereby; permission is hereby granted free of charge to any person obtaining a copy of this software
mit; 60; substantial; (?:shall|must) be included in all copies or substantial portions of the software
mit-0; 92; mit; spdx license identifier mit 0
mit-0; 85; mit; mit no attribution(?: licen[sc]e)?
x11; 80; x11; (?:under )?(?:the )?x11 licen[sc]e
x11; 90; x11; spdx license identifier x11
isc; 90; isc; spdx license identifier isc
isc; 75; isc; (?:the )?isc licen[sc]e
isc; 80; purpose; permission to use copy modify and or distribute this software for any purpose with or without fee
0bsd; 90; 0bsd; spdx license identifier 0bsd
0bsd; 80; bsd; (?:bsd zero clause|zero clause bsd)(?: licen[sc]e)?
bsd-2-clause; 90; bsd; spdx license identifier bsd 2 clause
bsd-3-clause; 90; bsd; spdx license identifier bsd 3 clause
bsd-4-clause; 90; bsd; spdx license identifier bsd 4 clause
bsd-2-clause; 80; bsd|freebsd; (?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd) licen[sc]e
bsd-2-clause; 75; bsd; bsd 2 clause
bsd-3-clause; 80; bsd; (?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd) licen[sc]e
bsd-3-clause; 75; bsd; bsd 3 clause
bsd-4-clause; 80; bsd; (?:bsd 4 clause|4 clause bsd|original bsd|old bsd) licen[sc]e
bsd; 50; bsd; (?:licensed|released|distributed|available) under (?:the |a )?bsd(?: style| type)? licen[sc]e
bsd; 45; bsd; bsd (?:style |type )?licen[sc]e
bsd-4-clause; 70; advertising; all advertising materials mentioning features or use of this software
bsd-3-clause; 70; endorse; (?:may|must not) be used to endorse or promote products derived from this software
bsd; 60; redistribution; redistribution and use in source and binary forms with or without modification are permitted
bsd-protection; 80; bsd; bsd protection licen[sc]e
gpl-3.0; 92; gnu; licensed under the gnu general public licen[sc]e version 3
gpl-3.0; 90; gpl; spdx license identifier gpl 3 0(?: only)?
gpl-3.0+; 93; gpl; spdx license identifier gpl 3 0 or later
gpl-2.0; 90; gpl; spdx license identifier gpl 2 0(?: only)?
gpl-2.0+; 93; gpl; spdx license identifier gpl 2 0 or later
gpl-1.0; 90; gpl; spdx license identifier gpl 1 0(?: only| or later)?
gpl-3.0; 85; general; (?:gnu )?general public licen[sc]e(?: as published by the free software foundation)? version 3(?: 0)?
gpl-2.0; 85; general; (?:gnu )?general public licen[sc]e(?: as published by the free software foundation)? version 2(?: 0)?
gpl-1.0; 85; general; (?:gnu )?general public licen[sc]e version 1(?: 0)?
gpl-3.0+; 90; general; (?:gnu )?general public licen[sc]e(?: \S+){0,8} either version 3 of the license or at your option any later version
gpl-2.0+; 90; general; (?:gnu )?general public licen[sc]e(?: \S+){0,8} either version 2 of the license or at your option any later version
gpl-3.0; 75; gplv3; (?:gnu )?gplv3(?: licen[sc]e)?
gpl-3.0+; 78; gplv3; (?:gnu )?gplv3 or later
gpl-2.0; 75; gplv2; (?:gnu )?gplv2(?: licen[sc]e)?
gpl-2.0+; 78; gplv2; (?:gnu )?gplv2 or later
gpl-3.0; 75; gpl; (?:gnu )?gpl (?:version |v )?3(?: 0)?
gpl-2.0; 75; gpl; (?:gnu )?gpl (?:version |v )?2(?: 0)?
gpl; 45; gpl; (?:under|with) (?:the )?(?:gnu )?gpl
gpl; 40; gnu; gnu general public licen[sc]e
gpl; 40; gnu; gnu gpl
gpl; 55; gnu; you should have received a copy of the gnu general public licen[sc]e
lgpl-2.1; 90; lgpl; spdx license identifier lgpl 2 1(?: only| or later)?
lgpl-3.0; 90; lgpl; spdx license identifier lgpl 3 0(?: only| or later)?
lgpl-2.0; 90; lgpl; spdx license identifier lgpl 2 0(?: only| or later)?
lgpl-2.1; 88; lesser; (?:gnu )?lesser general public licen[sc]e version 2 1
lgpl-3.0; 88; lesser; (?:gnu )?lesser general public licen[sc]e version 3(?: 0)?
lgpl-2.0; 88; library; (?:gnu )?library general public licen[sc]e version 2(?: 0)?
lgpl; 70; lesser; (?:gnu )?lesser general public licen[sc]e
lgpl; 70; library; gnu library general public licen[sc]e
lgpl-2.1; 75; lgplv2; lgplv2(?: 1)?
lgpl-3.0; 75; lgplv3; lgplv3
lgpl; 50; lgpl; (?:gnu )?lgpl(?: licen[sc]e)?
agpl-3.0; 90; agpl; spdx license identifier agpl 3 0(?: only| or later)?
agpl-3.0; 89; affero; (?:gnu )?affero general public licen[sc]e version 3(?: 0)?
agpl; 72; affero; (?:gnu )?affero general public licen[sc]e
agpl-3.0; 75; agplv3; (?:gnu )?agplv3
agpl; 50; agpl; (?:gnu )?agpl(?: licen[sc]e)?
gfdl-1.3; 85; documentation; (?:gnu )?free documentation licen[sc]e version 1 3
gfdl-1.2; 85; documentation; (?:gnu )?free documentation licen[sc]e version 1 2
gfdl-1.1; 85; documentation; (?:gnu )?free documentation licen[sc]e version 1 1
gfdl; 65; documentation; (?:gnu )?free documentation licen[sc]e
gfdl; 60; gfdl; (?:gnu )?gfdl
mpl-2.0; 90; mpl; spdx license identifier mpl 2 0
mpl-1.1; 90; mpl; spdx license identifier mpl 1 1
mpl-2.0; 85; mozilla; mozilla public licen[sc]e (?:version |v )?2 0
mpl-1.1; 85; mozilla; mozilla public licen[sc]e (?:version |v )?1 1
mpl-1.0; 85; mozilla; mozilla public licen[sc]e (?:version |v )?1 0
mpl; 60; mozilla; mozilla public licen[sc]e
mpl-2.0; 70; mpl; mpl (?:version |v )?2 0
mpl-1.1; 70; mpl; mpl (?:version |v )?1 1
npl-1.1; 80; netscape; netscape public licen[sc]e (?:version )?1 1
npl; 60; netscape; netscape public licen[sc]e
epl-2.0; 90; epl; spdx license identifier epl 2 0
epl-1.0; 90; epl; spdx license identifier epl 1 0
epl-2.0; 85; eclipse; eclipse public licen[sc]e (?:version |v )?2 0
epl-1.0; 85; eclipse; eclipse public licen[sc]e (?:version |v )?1 0
epl; 60; eclipse; eclipse public licen[sc]e
edl-1.0; 80; eclipse; eclipse distribution licen[sc]e(?: version| v)?(?: 1 0)?
cddl-1.0; 90; cddl; spdx license identifier cddl 1 0
cddl-1.1; 90; cddl; spdx license identifier cddl 1 1
cddl-1.0; 85; distribution; common development and distribution licen[sc]e (?:version )?1 0
cddl-1.1; 85; distribution; common development and distribution licen[sc]e (?:version )?1 1
cddl; 60; distribution; common development and distribution licen[sc]e
cddl; 50; cddl; cddl(?: licen[sc]e)?
cpl-1.0; 80; common; common public licen[sc]e(?: version)? 1 0
cpl; 60; common; common public licen[sc]e
ipl-1.0; 80; ibm; ibm public licen[sc]e(?: version)?(?: 1 0)?
artistic-2.0; 90; artistic; spdx license identifier artistic 2 0
artistic-2.0; 85; artistic; artistic licen[sc]e (?:version |v )?2 0
artistic-1.0; 85; artistic; artistic licen[sc]e (?:version |v )?1 0
artistic; 60; artistic; (?:the )?artistic licen[sc]e
perl; 65; perl; under the same terms as perl itself
bsl-1.0; 90; bsl; spdx license identifier bsl 1 0
bsl-1.0; 85; boost; boost software licen[sc]e(?: version)?(?: 1 0)?
busl-1.1; 90; busl; spdx license identifier busl 1 1
busl-1.1; 85; business; business source licen[sc]e(?: version)?(?: 1 1)?
zlib; 90; zlib; spdx license identifier zlib
zlib; 75; zlib; (?:the )?zlib(?: libpng)? licen[sc]e
zlib; 70; misrepresented; the origin of this software must not be misrepresented
libpng; 75; libpng; (?:the )?libpng licen[sc]e
unlicense; 90; unlicense; spdx license identifier unlicense
unlicense; 80; unlicense; (?:the )?unlicense
unlicense; 85; unencumbered; this is free and unencumbered software released into the public domain
wtfpl; 85; wtfpl; (?:the )?wtfpl(?: licen[sc]e)?
wtfpl; 80; want; do what the \S+ you want to public licen[sc]e
beerware; 80; beerware; (?:the )?beerware licen[sc]e
beerware; 75; beer; the beer ware licen[sc]e
cc0-1.0; 90; cc0; spdx license identifier cc0 1 0
cc0-1.0; 85; cc0; cc0 1 0(?: universal)?
cc0; 70; cc0; (?:creative commons )?cc0
cc-by-4.0; 92; cc; spdx license identifier cc by 4 0
cc-by-3.0; 92; cc; spdx license identifier cc by 3 0
cc-by-sa-4.0; 92; cc; spdx license identifier cc by sa 4 0
cc-by-nc-4.0; 92; cc; spdx license identifier cc by nc 4 0
cc-by-4.0; 80; cc; cc by 4 0
cc-by-3.0; 80; cc; cc by 3 0
cc-by-2.5; 80; cc; cc by 2 5
cc-by-2.0; 80; cc; cc by 2 0
cc-by-1.0; 80; cc; cc by 1 0
cc-by-sa-4.0; 82; cc; cc by sa 4 0
cc-by-sa-3.0; 82; cc; cc by sa 3 0
cc-by-sa-2.5; 82; cc; cc by sa 2 5
cc-by-sa-2.0; 82; cc; cc by sa 2 0
cc-by-sa; 74; cc; cc by sa
cc-by-nc-4.0; 82; cc; cc by nc 4 0
cc-by-nc-3.0; 82; cc; cc by nc 3 0
cc-by-nc-2.5; 82; cc; cc by nc 2 5
cc-by-nc-2.0; 82; cc; cc by nc 2 0
cc-by-nc; 74; cc; cc by nc
cc-by-nd-4.0; 82; cc; cc by nd 4 0
cc-by-nd-3.0; 82; cc; cc by nd 3 0
cc-by-nd; 74; cc; cc by nd
cc-by-nc-sa-4.0; 84; cc; cc by nc sa 4 0
cc-by-nc-sa-3.0; 84; cc; cc by nc sa 3 0
cc-by-nc-sa; 76; cc; cc by nc sa
cc-by-nc-nd-4.0; 84; cc; cc by nc nd 4 0
cc-by-nc-nd-3.0; 84; cc; cc by nc nd 3 0
cc-by-nc-nd; 76; cc; cc by nc nd
cc-by-4.0; 85; creative; creative commons attribution 4 0(?: international)?(?: public)?(?: licen[sc]e)?
cc-by-3.0; 85; creative; creative commons attribution 3 0(?: unported)?(?: licen[sc]e)?
cc-by; 60; creative; creative commons attribution(?: licen[sc]e)?
cc-by-sa-4.0; 87; creative; creative commons attribution share ?alike 4 0(?: international)?(?: licen[sc]e)?
cc-by-sa-3.0; 87; creative; creative commons attribution share ?alike 3 0(?: unported)?(?: licen[sc]e)?
cc-by-sa; 70; creative; creative commons attribution share ?alike(?: licen[sc]e)?
cc-by-nc-4.0; 87; creative; creative commons attribution non ?commercial 4 0(?: international)?(?: licen[sc]e)?
cc-by-nc; 70; creative; creative commons attribution non ?commercial(?: licen[sc]e)?
cc-by-nd; 70; creative; creative commons attribution no ?deriv(?:ative)?s?(?: licen[sc]e)?
cc-by-nc-sa; 75; creative; creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?
cc-by-nc-nd; 75; creative; creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: [1-4] [05])?
cc; 30; creative; (?:a |the )?creative commons(?: licen[sc]e)?
public-domain; 60; domain; (?:released|dedicated|placed|donated) (?:in)?to the public domain
public-domain; 45; domain; (?:is|are) in the public domain
public-domain; 35; domain; public domain
odbl-1.0; 85; odbl; (?:spdx license identifier )?odbl(?: 1 0)?
odbl-1.0; 80; database; open (?:data commons open )?database licen[sc]e(?: odbl)?
odc-by-1.0; 80; commons; open data commons attribution licen[sc]e
pddl-1.0; 80; dedication; (?:open data commons )?public domain dedication and licen[sc]e
ogl-uk-3.0; 80; government; open government licen[sc]e(?: v| version)? ?3(?: 0)?
ogl-uk; 65; government; open government licen[sc]e
etalab-2.0; 75; etalab; (?:licence ouverte )?etalab(?: 2 0)?
ofl-1.1; 90; ofl; spdx license identifier ofl 1 1
ofl-1.1; 85; font; sil open font licen[sc]e(?: version)?(?: 1 1)?
ofl; 65; font; open font licen[sc]e
ubuntu-font; 75; ubuntu; ubuntu font licen[sc]e(?: 1 0)?
bitstream-vera; 75; bitstream; bitstream vera fonts? (?:copyright|licen[sc]e)
psf-2.0; 85; python; python software foundation licen[sc]e(?: version)?(?: 2)?
python-2.0; 75; python; python licen[sc]e(?: 2 0)?
ruby; 75; ruby; (?:the )?ruby licen[sc]e
php-3.01; 80; php; php licen[sc]e(?: version)? 3 01
php; 65; php; (?:the )?php licen[sc]e
zpl-2.1; 75; zope; zope public licen[sc]e(?: version)?(?: 2 1)?
openssl; 75; openssl; (?:the )?openssl licen[sc]e
curl; 75; curl; (?:the )?curl licen[sc]e
ncsa; 75; illinois; university of illinois(?: ncsa)? open source licen[sc]e
ncsa; 70; ncsa; ncsa open source licen[sc]e
upl-1.0; 80; permissive; universal permissive licen[sc]e(?: version| v)?(?: 1 0)?
afl-3.0; 80; academic; academic free licen[sc]e(?: version| v)? 3 0
afl; 65; academic; academic free licen[sc]e
ecl-2.0; 80; educational; educational community licen[sc]e(?: version)?(?: 2 0)?
osl-3.0; 80; open; open software licen[sc]e(?: version| v)? 3 0
osl; 65; open; open software licen[sc]e
ms-pl; 80; microsoft; microsoft public licen[sc]e
ms-rl; 80; microsoft; microsoft reciprocal licen[sc]e
eupl-1.2; 85; eupl|eupl1; eupl(?: version| v)? ?1 2
eupl-1.1; 85; eupl|eupl1; eupl(?: version| v)? ?1 1
eupl; 70; european; european union public licen[sc]e
cecill-2.1; 80; cecill; cecill(?: free software licen[sc]e agreement)?(?: version| v)? 2 1
cecill; 65; cecill; cecill(?: [bc])?(?: licen[sc]e)?
apsl-2.0; 80; apple; apple public source licen[sc]e(?: version)?(?: 2 0)?
qpl-1.0; 75; q|qt|qpublic|qtpublic; (?:the )?q(?:t)? ?public licen[sc]e(?: qpl)?
sleepycat; 75; sleepycat; (?:the )?sleepycat licen[sc]e
postgresql; 75; postgresql; (?:the )?postgresql licen[sc]e
unicode; 75; unicode; unicode (?:data files and software |inc )?licen[sc]e(?: agreement)?
w3c; 75; w3c; w3c software(?: notice and| and document)? licen[sc]e
vim; 75; vim; (?:the )?vim licen[sc]e
lppl-1.3; 80; latex; latex project public licen[sc]e(?: version)?(?: 1 3[abc]?)?
ijg; 75; jpeg; independent jpeg group(?: s)? (?:software|licen[sc]e)
mulan-psl-2.0; 80; mulan; mulan permissive software licen[sc]e(?: version| v)?(?: ?2)?
sspl-1.0; 85; server; server side public licen[sc]e(?: version| v)?(?: ?1)?
elastic-2.0; 80; elastic; elastic licen[sc]e(?: version)?(?: 2 0)?
commons-clause; 80; clause; commons clause(?: licen[sc]e condition)?
polyform-nc; 80; polyform; polyform noncommercial licen[sc]e
openrail; 75; openrail; (?:bigscience |creativeml )?openrail(?: m)?(?: licen[sc]e)?
llama; 70; llama; llama (?:[23] )?community licen[sc]e
json; 70; evil; the software shall be used for good not evil
hippocratic; 75; hippocratic; hippocratic licen[sc]e
gsl; 65; gust; gust font licen[sc]e
reserved; 55; reserved; copyright (?:c )?(?:[0-9]{4} )?(?:\S+ ){0,6}all rights reserved
reserved; 50; reserved; all rights reserved
reserved; 45; reserved; (?:some|certain|no) rights reserved
reserved; 55; droits; tous droits reserves
reserved; 55; réservés; tous droits réservés
reserved; 55; rechte; alle rechte vorbehalten
reserved; 55; derechos; todos los derechos reservados
proprietary; 60; proprietary; (?:proprietary and confidential|confidential and proprietary)
proprietary; 55; proprietary; (?:this|the) (?:software|document|work) is proprietary
proprietary; 55; permission; (?:may not|must not|cannot) be (?:copied|reproduced|redistributed) without (?:\S+ ){0,3}permission
proprietary; 50; unauthorized; unauthorized (?:copying|reproduction|distribution)(?: or (?:copying|reproduction|distribution))?(?: \S+){0,6} prohibited
proprietary; 55; agreement|eula; (?:end user licen[sc]e agreement|eula)(?: eula)?
non-commercial; 50; commercial; for non commercial use only
non-commercial; 50; noncommercial; for noncommercial use only
non-commercial; 45; personal; for personal use only
copyright; 30; copyright; copyright (?:c |by )?(?:[0-9]{4} )(?:[0-9]{4} )?\S+
copyright; 25; copyright|copyrights; (?:all )?copyright(?:s)? (?:by|of|is held by) \S+
license; 15; license; (?:is|are) licensed under \S+ \S+ license
license; 12; licensed|released|distributed; (?:licensed|released|distributed) under (?:the )?\S+(?: \S+)? \S+
license; 10; licence; under (?:the )?\S+(?: \S+)? licence
"""
