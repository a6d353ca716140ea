"""Ordered license signatures.

Every line of a table is ``label | weight | keywords | regex``. A regex is matched against
the words of a text, lower-cased and joined by single blanks, and begins and ends at word
borders. A rule is tried only if all its keywords (words of that text) occur; where alternatives
hold different words, sets of keywords stand behind commas, and one set is enough. Tables come in
order of priority: what stands in an earlier table, or earlier in the same one, goes first.
"""

from __future__ import annotations

#: Phrases out of license texts and notices.
NOTICES = r"""
mit | 0.97 | permission charge | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | 0.90 | copyright notice permission | the above copyright notice and this permission notice (?:\w+ ){0,6}shall be included in all copies or substantial portions
mit-0 | 0.90 | mit attribution | mit no attribution
isc | 0.95 | permission purpose | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
0bsd | 0.90 | zero clause | (?:bsd )?zero clause (?:bsd )?license
zlib | 0.95 | altered | altered source versions must be plainly marked as such
zlib | 0.80 | warranty liable | this software is provided as is without any express or implied warranty in no event will the authors be held liable
bsd | 0.85 | redistribution binary | redistribution and use in source and binary forms with or without modification are permitted
bsd-3-clause | 0.95 | endorse | neither the name of (?:\S+ ){1,12}nor the names of its contributors may be used to endorse or promote products
bsd-4-clause | 0.95 | advertising acknowledgement | all advertising materials mentioning features or use of this software must display the following acknowledgement
bsd-2-clause | 0.80 | redistributions reproduce | redistributions in binary form must reproduce the above copyright notice
bsd-3-clause-clear | 0.95 | patent express | no express or implied licenses to any partys? patent rights are granted by this license
bsl-1.0 | 0.95 | accompanying covered, boost | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license|boost software license version 1 0
apache-2.0 | 0.97 | apache | licensed under the apache license version 2 0
apache-2.0 | 0.85 | limitations governing | see the license for the specific language governing permissions and limitations under the license
apache-2.0 | 0.80 | compliance | you may not use this file except in compliance with the license
apache-1.1 | 0.90 | apache | apache software license version 1 1
apache-1.0 | 0.90 | apache | apache (?:software )?license version 1 0
gpl-3.0-or-later | 0.97 | gnu later | gnu general public license as published by the free software foundation either version 3 (?:of the license )?or (?:at your option )?any later version
gpl-2.0-or-later | 0.97 | gnu later | gnu general public license as published by the free software foundation either version 2 (?:of the license )?or (?:at your option )?any later version
gpl-1.0-or-later | 0.95 | gnu later | gnu general public license as published by the free software foundation either version 1 or (?:at your option )?any later version
lgpl-3.0-or-later | 0.97 | gnu lesser later | gnu lesser general public license as published by the free software foundation either version 3 (?:of the license )?or (?:at your option )?any later version
lgpl-2.1-or-later | 0.97 | gnu lesser later | gnu lesser general public license as published by the free software foundation either version 2 1 (?:of the license )?or (?:at your option )?any later version
lgpl-2.0-or-later | 0.97 | gnu library later | gnu library general public license as published by the free software foundation either version 2 (?:of the license )?or (?:at your option )?any later version
agpl-3.0-or-later | 0.97 | gnu affero later | gnu affero general public license as published by the free software foundation either version 3 (?:of the license )?or (?:at your option )?any later version
gpl-2.0-only | 0.95 | gnu | gnu general public license version 2 (?:only )?as published by the free software foundation
gpl-3.0-only | 0.95 | gnu | gnu general public license version 3 (?:only )?as published by the free software foundation
gfdl | 0.95 | gnu invariant | gnu free documentation license (?:version \d(?: \d)? )?(?:\S+ ){0,30}invariant sections
gfdl | 0.85 | gnu documentation | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
gpl | 0.80 | gnu warranty | this program is distributed in the hope that it will be useful but without any warranty (?:\S+ ){0,30}gnu general public license
gpl | 0.70 | gnu copy | you should have received a copy of the gnu general public license
lgpl | 0.70 | gnu copy lesser | you should have received a copy of the gnu lesser general public license
agpl | 0.70 | gnu copy affero | you should have received a copy of the gnu affero general public license
gpl-classpath-exception | 0.90 | classpath, special exception link | classpath exception|as a special exception the copyright holders of this library give you permission to link this library
gpl-bison-exception | 0.85 | bison exception | as a special exception you may create a larger work that contains part or all of the bison parser skeleton
gpl-font-exception | 0.85 | font exception | as a special exception if you create a document which uses this font
mpl-2.0 | 0.97 | mozilla | this source code form is subject to the terms of the mozilla public license v(?:ersion)? ?2 0
mpl-1.1 | 0.95 | mozilla | subject to the mozilla public license version 1 1
mpl-1.0 | 0.90 | mozilla | subject to the mozilla public license version 1 0
epl-2.0 | 0.95 | eclipse | made available under the terms of the eclipse public license (?:v(?:ersion)? ?)?2 0
epl-1.0 | 0.95 | eclipse | made available under the terms of the eclipse public license (?:v(?:ersion)? ?)?1 0
cddl-1.0 | 0.95 | common development, cddl | subject to the terms of the common development and distribution license|cddl (?:version )?1 0
cddl-1.1 | 0.90 | cddl | cddl (?:version )?1 1
cpl-1.0 | 0.90 | common | common public license (?:version |v )?1 0
eupl-1.2 | 0.95 | eupl | licensed under the eupl (?:\S+ ){0,6}1 2
eupl-1.1 | 0.90 | eupl | licensed under the eupl (?:\S+ ){0,6}1 1
ms-pl | 0.90 | microsoft | microsoft public license
ms-rl | 0.90 | microsoft | microsoft reciprocal license
artistic-2.0 | 0.90 | artistic | artistic license (?:version )?2 0
artistic-1.0 | 0.80 | perl itself, artistic | same terms as perl itself|artistic license (?:version )?1 0
openssl | 0.90 | openssl | this product includes software developed by the openssl project
php-3.01 | 0.90 | php | php license (?:version |v )?3 01
python-2.0 | 0.90 | python foundation | python software foundation license
ruby | 0.80 | ruby | same terms as ruby|ruby license
unlicense | 0.97 | unencumbered | this is free and unencumbered software released into the public domain
wtfpl | 0.95 | public | do what the (?:f\S{2,6}|hell) you want to public license
cc0-1.0 | 0.95 | waived | (?:has|have) waived all copyright and related or neighboring rights
cc0-1.0 | 0.90 | cc0 | cc0 1 0 universal
public-domain | 0.70 | public domain | (?:released|placed|dedicated) (?:in|in ?to|to) the public domain
public-domain | 0.50 | public domain | (?:is|are) in the public domain
ofl-1.1 | 0.95 | sil | sil open font license (?:version |v )?1 1
odbl-1.0 | 0.90 | open database | open (?:data commons )?(?:open )?database license
odc-by-1.0 | 0.90 | commons attribution | open data commons attribution license
pddl-1.0 | 0.90 | domain dedication | public domain dedication and license
cdla-permissive-2.0 | 0.90 | community permissive | community data license agreement permissive version 2 0
cdla-permissive-1.0 | 0.90 | community permissive | community data license agreement permissive version 1 0
cdla-sharing-1.0 | 0.90 | community sharing | community data license agreement sharing version 1 0
elastic-2.0 | 0.90 | elastic | elastic license (?:version |v )?2 0
sspl-1.0 | 0.90 | server side | server side public license
busl-1.1 | 0.90 | business | business source license (?:version )?1 1
polyform-noncommercial | 0.90 | polyform | polyform noncommercial license
polyform-small-business | 0.90 | polyform | polyform small business license
openrail-m | 0.85 | rail, openrail | (?:creativeml )?open rail(?: m)?(?: license)?|openrail m license
llama-community | 0.85 | llama community | llama(?: \d)* community license
upl-1.0 | 0.90 | universal permissive | universal permissive license
ncsa | 0.90 | illinois | university of illinois (?:ncsa )?open source license
postgresql | 0.85 | postgresql | postgresql license
x11 | 0.85 | x11 | x11 license
w3c | 0.85 | w3c | w3c software (?:notice and )?license
afl-3.0 | 0.85 | academic | academic free license (?:version )?3 0
osl-3.0 | 0.85 | open | open software license (?:version |v )?3 0
ecl-2.0 | 0.85 | educational | educational community license
vim | 0.80 | vim | vim license
curl | 0.80 | curl | curl license
json | 0.85 | good evil | the software shall be used for good not evil
beerware | 0.85 | beer, beerware | the beer ?ware license|you can buy me a beer in return
cecill-2.1 | 0.85 | cecill | cecill (?:license )?(?:version )?2 1
cecill-b | 0.85 | cecill | cecill b
cecill-c | 0.85 | cecill | cecill c
mulan-psl-2.0 | 0.85 | mulan | mulan permissive software license
proprietary | 0.60 | rights reserved | all rights reserved
proprietary | 0.80 | confidential proprietary | (?:confidential and proprietary|proprietary and confidential)
proprietary | 0.70 | prohibited | unauthorized (?:copying|use|distribution)(?: \S+){0,8} is strictly prohibited
no-derivatives | 0.60 | reproduced permission | (?:may not|no part \S+(?: \S+){0,4}) be reproduced (?:\S+ ){0,12}without (?:the )?(?:prior )?(?:written )?permission
non-commercial | 0.60 | commercial, noncommercial | for non ?commercial (?:use|purposes)(?: only)?
eula | 0.60 | end agreement | end user licen[cs]e agreement
"""

#: More phrases of texts, and licenses that are named less often.
FURTHER = r"""
mit | 0.85 | sublicense merge | the rights to use copy modify merge publish distribute sublicense and or sell copies of the software
mit | 0.70 | connection dealings | arising from out of or in connection with the software or the use or other dealings in the software
mit | 0.75 | advertising promote | except as contained in this notice the name of (?:\S+ ){1,10}shall not be used in advertising or otherwise to promote
hpnd | 0.85 | fee granted | permission to use copy modify (?:and )?distribute (?:and sell )?this software and its documentation for any purpose (?:is hereby granted without fee|without fee is hereby granted)
hpnd | 0.75 | representations suitability | makes no representations about the suitability of this software for any purpose
isc | 0.80 | author disclaims | the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness
isc | 0.70 | tortious | negligence or other tortious action arising out of or in connection with the use or performance of this software
zlib | 0.85 | misrepresented | the origin of this software must not be misrepresented you must not claim that you wrote the original software
zlib | 0.80 | notice altered | this notice may not be removed or altered from any source distribution
libpng | 0.85 | png | png reference library(?: license)?
bsd | 0.75 | redistributions retain | redistributions of source code must retain the (?:above )?copyright notice this list of conditions and the following disclaimer
bsd | 0.65 | procurement substitute | procurement of substitute goods or services loss of use data or profits or business interruption
bsd-4-clause | 0.80 | includes developed | this product includes software developed by the university of california berkeley and its contributors
bsd-source-code | 0.75 | redistributions permitted | redistributions of source code are permitted provided that the above copyright notice is retained
bsd-protection | 0.85 | protection | bsd protection license
bsl-1.0 | 0.85 | derivative executable | unless such copies or derivative works are solely in the form of machine executable object code
apache-2.0 | 0.90 | perpetual contributor | each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license
apache-2.0 | 0.80 | express implied kind | distributed on an as is basis without warranties or conditions of any kind either express or implied
apache-2.0 | 0.75 | readable attribution | any derivative works that you distribute must include a readable copy of the attribution notices
apache-1.1 | 0.85 | includes apache | this product includes software developed by the apache software foundation
apache-1.0 | 0.80 | apache group | this product includes software developed by the apache group
gpl | 0.80 | freedom change | the licenses for most software are designed to take away your freedom to share and change it
gpl | 0.80 | freedom share | is intended to guarantee your freedom to share and change (?:free software|all versions of a program)
gpl-3.0 | 0.90 | propagate covered | you may not propagate or modify a covered work except as expressly provided under this license
gpl-3.0 | 0.85 | anti circumvention | protecting users legal rights from anti circumvention law
gpl-2.0 | 0.85 | derived program publish | you must cause any work that you distribute or publish that in whole or in part contains or is derived from the program
gpl-2.0 | 0.75 | foundation temple | free software foundation inc 59 temple place
gpl-2.0 | 0.75 | foundation franklin | free software foundation inc 51 franklin st(?:reet)?
gpl-1.0 | 0.75 | foundation mass | free software foundation inc 675 mass ave
gpl | 0.70 | write foundation | if not write to the free software foundation
lgpl-2.1 | 0.85 | work uses library | a work that uses the library
lgpl-3.0 | 0.85 | combined linking | a combined work is a work produced by combining or linking an application with the library
lgpl | 0.75 | reverse engineering | permit modification of the work for the customers own use and reverse engineering for debugging such modifications
agpl-3.0 | 0.90 | remotely interacting | all users interacting with it remotely through a computer network
agpl | 0.80 | network server | specifically designed to ensure cooperation with the community in the case of network server software
gpl-linking-exception | 0.85 | exception linking, exception link | linking exception|as a special exception (?:\S+ ){0,12}permission to link (?:the code of )?(?:this program|portions of this program)
gpl-openssl-exception | 0.85 | openssl exception, openssl link | openssl exception|permission to link (?:\S+ ){1,14}with the openssl library
gpl-gcc-exception | 0.85 | gcc runtime exception | gcc runtime library exception
gpl-autoconf-exception | 0.85 | autoconf exception | as a special exception to the gnu general public license if you distribute this file as part of a program that contains a configuration script generated by autoconf
llvm-exception | 0.85 | llvm | (?:apache license (?:v ?|version )?2 0 with )?llvm exceptions?
gfdl-1.3 | 0.90 | documentation 1 3 | gnu free documentation license version 1 3
gfdl-1.2 | 0.90 | documentation 1 2 | gnu free documentation license version 1 2
gfdl-1.1 | 0.90 | documentation 1 1 | gnu free documentation license version 1 1
gfdl | 0.75 | front cover texts | with no invariant sections no front cover texts and no back cover texts
mpl-2.0 | 0.90 | obtain mozilla | if a copy of the mpl was not distributed with this file you can obtain one at (?:https? )?(?:www )?mozilla org mpl 2 0
mpl-2.0 | 0.85 | incompatible secondary | this source code form is incompatible with secondary licenses
mpl-1.1 | 0.85 | initial developer | the initial developer of the original code is
mpl-1.1 | 0.80 | basis governing | software distributed under the license is distributed on an as is basis without warranty of any kind either express or implied see the license for the specific language governing rights
npl-1.1 | 0.85 | netscape | netscape public license (?:version )?1 1
npl-1.0 | 0.85 | netscape | netscape public license (?:version )?1 0
npl | 0.70 | netscape | netscape public license
epl-2.0 | 0.80 | eclipse secondary | secondary licenses when the conditions for such availability set forth in the eclipse public license
epl | 0.80 | agreement recipients | any use reproduction or distribution of the program constitutes recipients acceptance of this agreement
ipl-1.0 | 0.85 | ibm | ibm public license (?:version )?1 0
spl-1.0 | 0.85 | sun | sun public license (?:version )?1 0
apsl-2.0 | 0.85 | apple | apple public source license (?:version )?2 0
apsl-1.2 | 0.85 | apple | apple public source license (?:version )?1 2
apsl | 0.70 | apple | apple public source license
cddl-1.0 | 0.85 | cddl header | cddl header start
cpal-1.0 | 0.85 | attribution common | common public attribution license(?: version 1 0)?
qpl-1.0 | 0.85 | q | (?:the )?q public license(?: version 1 0)?
sleepycat | 0.85 | sleepycat | sleepycat (?:public |software )?license
rpl-1.5 | 0.85 | reciprocal | reciprocal public license (?:version )?1 5
rpl | 0.70 | reciprocal | reciprocal public license
nosl | 0.80 | netizen | netizen open source license
nasa-1.3 | 0.85 | nasa | nasa open source agreement(?: version 1 3)?
lppl-1.3c | 0.90 | latex 1 3c | latex project public license (?:version )?1 3c
lppl-1.3 | 0.85 | latex 1 3 | latex project public license (?:either )?(?:version )?1 3
lppl | 0.75 | latex | latex project public license
ofl-1.1 | 0.85 | reserved font | (?:with )?reserved font names?
ofl-1.0 | 0.85 | sil | sil open font license (?:version |v )?1 0
ubuntu-font-1.0 | 0.85 | ubuntu font | ubuntu font licen[cs]e
bitstream-vera | 0.85 | bitstream | bitstream vera (?:fonts )?copyright
arphic | 0.85 | arphic | arphic public license
unicode-dfs | 0.85 | unicode | unicode (?:inc )?license agreement(?: data files and software)?
icu | 0.80 | icu | icu license
ijg | 0.80 | independent jpeg | this software is based in part on the work of the independent jpeg group
freetype | 0.85 | freetype | (?:the )?freetype (?:project )?license
imagemagick | 0.85 | imagemagick | imagemagick license
tcl | 0.80 | tcl | tcl tk license|tcl license
perl | 0.75 | gnu artistic | under the terms of either the gnu general public license (?:\S+ ){0,12}or the artistic license
psf-2.0 | 0.85 | psf | psf license agreement(?: for python)?
cnri-python | 0.85 | cnri | cnri open source license agreement|cnri python license
zpl-2.1 | 0.85 | zope | zope public license (?:zpl )?(?:version )?2 1
zpl-2.0 | 0.85 | zope | zope public license (?:zpl )?(?:version )?2 0
zpl | 0.70 | zope | zope public license
php-3.0 | 0.85 | php | php license (?:version |v )?3 0
xiph | 0.75 | xiph | xiph org foundation (?:\S+ ){0,6}bsd
intel | 0.80 | intel | intel (?:open source|simplified software|obsolete) license
nvidia | 0.75 | nvidia | nvidia (?:source code|software|open model) license(?: agreement)?
oracle-bcl | 0.80 | oracle binary | oracle binary code license agreement
oracle-fdl | 0.75 | oracle | oracle free use terms and conditions|oracle technology network license agreement
sun-bcla | 0.80 | sun binary | sun microsystems inc binary code license agreement
adobe | 0.70 | adobe | adobe (?:systems incorporated )?(?:source code|glyph list) license(?: agreement)?
truecrypt | 0.80 | truecrypt | truecrypt license
unrar | 0.85 | unrar, rar | unrar license|may not be used to develop a rar winrar compatible archiver|may not be used to re create the rar compression algorithm
info-zip | 0.85 | info zip | info zip license
bzip2 | 0.80 | bzip2 | bzip2 (?:libbzip2 )?license
sqlite-blessing | 0.85 | evil forgive | may you do good and not evil may you find forgiveness for yourself and forgive others
hippocratic | 0.85 | hippocratic | hippocratic license(?: version)?(?: \d \d)?
anti-996 | 0.85 | 996 | anti 996 license(?: version 1 0)?
parity | 0.80 | parity | parity public license(?: \d+ \d+ \d+)?
prosperity | 0.80 | prosperity | prosperity public license(?: \d+ \d+ \d+)?
blueoak-1.0.0 | 0.85 | oak, blueoak | blue ?oak model license(?: 1 0 0)?
cern-ohl | 0.80 | cern | cern open hardware licen[cs]e(?: version \d)?
solderpad | 0.80 | solderpad | solderpad hardware license
tapr-ohl | 0.80 | tapr | tapr open hardware license
copyfree | 0.70 | copyfree | copyfree open innovation license
fair | 0.75 | instrument retained | usage of the works is permitted provided that this instrument is retained with the works
coil-1.0 | 0.75 | coil | copyfree open innovation license coil|coil 1 0
wordnet | 0.80 | wordnet | wordnet (?:\d \d )?license
ogl-uk-3.0 | 0.85 | government 3, government v3 | open government licen[cs]e (?:version |v |v)?3(?: 0)?
ogl-uk | 0.75 | government | open government licen[cs]e
etalab-2.0 | 0.85 | licence ouverte | licence ouverte(?: open licence)?(?: etalab)?(?: version)?(?: 2 0)?
dl-de-by-2.0 | 0.85 | datenlizenz namensnennung | datenlizenz deutschland namensnennung(?: version)?(?: 2 0)?
dl-de-zero-2.0 | 0.85 | datenlizenz zero | datenlizenz deutschland zero(?: version)?(?: 2 0)?
iodl-2.0 | 0.80 | italian data | italian open data license(?: v2| 2)?(?: 0)?
kogl | 0.75 | korea | korea open government license
odbl-1.0 | 0.85 | opendatacommons odbl | (?:www )?opendatacommons org licenses odbl(?: 1 0)?
odc-by-1.0 | 0.85 | opendatacommons by | (?:www )?opendatacommons org licenses by(?: 1 0)?
pddl-1.0 | 0.85 | opendatacommons pddl | (?:www )?opendatacommons org licenses pddl(?: 1 0)?
c-uda-1.0 | 0.80 | computational data | computational use of data agreement
cc-sampling | 0.80 | creative sampling | creative commons sampling(?: plus)?(?: 1 0)?
cc-by-nc-sa | 0.70 | remix commercial | you may not use the material for commercial purposes if you remix transform or build upon the material
cc-by-sa | 0.75 | remix contributions | if you remix transform or build upon the material you must distribute your contributions under the same license
cc-by | 0.75 | appropriate credit | you must give appropriate credit provide a link to the license and indicate if changes were made
cc-by | 0.60 | some rights reserved | some rights reserved
cc0-1.0 | 0.85 | copyright deed, affirmer | no copyright the person who associated a work with this deed|affirmer hereby overtly fully permanently irrevocably and unconditionally waives
copyleft | 0.60 | copyleft free art, licence art libre | free art license copyleft attitude|copyleft free art license|licence art libre
opl-1.0 | 0.80 | publication open | open publication license(?: v1 0| version 1 0)?
dsl | 0.75 | design science | design science license
gemma | 0.80 | gemma | gemma (?:terms of use|license)
qwen | 0.80 | qwen | (?:tongyi )?qwen (?:research )?license(?: agreement)?
falcon-llm | 0.80 | falcon | falcon(?: \S+)? llm license|tii falcon license
stability-community | 0.80 | stability | stability ai (?:non commercial research )?community license(?: agreement)?
bigcode-openrail-m | 0.85 | bigcode | bigcode open ?rail m(?: v1)?(?: license)?
deepseek | 0.75 | deepseek | deepseek (?:model )?license(?: agreement)?
bigscience-bloom-rail | 0.85 | bigscience | bigscience (?:bloom )?rail(?: license)?(?: 1 0)?
yi | 0.70 | yi | yi (?:series models )?(?:community )?license agreement
commons-clause | 0.85 | commons clause | commons clause(?: license condition)?(?: v1 0)?
confluent-community | 0.80 | confluent | confluent community license(?: agreement)?
mariadb-bsl | 0.75 | change | change license(?: \S+){0,6} gpl(?: \S+){0,4} later
polyform-perimeter | 0.80 | polyform perimeter | polyform perimeter license
polyform-shield | 0.80 | polyform shield | polyform shield license
polyform-strict | 0.80 | polyform strict | polyform strict license
fsl-1.1 | 0.85 | functional source | functional source license(?: version 1 1)?
timescale | 0.75 | timescale | timescale license(?: agreement)?
redis-source-available | 0.80 | redis available | redis source available license(?: agreement)?
shareware | 0.60 | shareware trial, shareware evaluation | this (?:software|program) is shareware (?:\S+ ){0,12}(?:trial|evaluation)
freeware | 0.55 | freeware | (?:this (?:software|program) is|distributed as|released as) freeware
evaluation-only | 0.60 | evaluation | for evaluation (?:purposes|use) only
academic-only | 0.65 | academic, research | for (?:academic|research)(?: and (?:academic|research|educational))? (?:use|purposes) only
educational-only | 0.60 | educational | for (?:personal and )?educational (?:use|purposes) only
personal-use | 0.55 | personal | for (?:your )?personal (?:use|non commercial use) only
no-redistribution | 0.65 | redistribute, redistribution | (?:you may not|do not) redistribute this (?:file|software|document|work)|redistribution (?:of this \S+ )?is (?:not permitted|prohibited|forbidden)
no-training | 0.60 | machine training, ai training | may not be used (?:\S+ ){0,6}to train (?:\S+ ){0,4}machine learning training models|not (?:to be used )?for ai training
trade-secret | 0.65 | trade secrets | contains (?:confidential information and )?trade secrets of
government-work | 0.65 | government work | work of the (?:united states|u s) government
crown-copyright | 0.75 | crown copyright | crown copyright
"""

#: Names with versions, addresses and short forms.
NAMES = r"""
gpl-3.0 | 0.85 | gnu | gnu general public license (?:gpl )?(?:version |v )?v?3(?: 0)?
gpl-2.0 | 0.85 | gnu | gnu general public license (?:gpl )?(?:version |v )?v?2(?: 0)?
lgpl-3.0 | 0.85 | gnu lesser | gnu lesser general public license (?:lgpl )?(?:version |v )?v?3(?: 0)?
lgpl-2.1 | 0.85 | gnu lesser | gnu lesser general public license (?:lgpl )?(?:version |v )?v?2 1
agpl-3.0 | 0.85 | gnu affero | gnu affero general public license (?:agpl )?(?:version |v )?v?3(?: 0)?
gpl-3.0 | 0.75 | gplv3 | gplv3
gpl-2.0 | 0.75 | gplv2 | gplv2
lgpl-3.0 | 0.75 | lgplv3 | lgplv3
lgpl-2.1 | 0.75 | lgplv2 | lgplv2 1
agpl-3.0 | 0.75 | agplv3 | agplv3
gpl-3.0 | 0.75 | gpl | gpl (?:version |v )?v?3(?: 0)?
gpl-2.0 | 0.75 | gpl | gpl (?:version |v )?v?2(?: 0)?
lgpl-3.0 | 0.75 | lgpl | lgpl (?:version |v )?v?3(?: 0)?
lgpl-2.1 | 0.75 | lgpl | lgpl (?:version |v )?v?2 1
agpl-3.0 | 0.75 | agpl | agpl (?:version |v )?v?3(?: 0)?
gpl | 0.70 | gnu org | (?:www )?gnu org (?:licenses|copyleft) gpl(?: \S+)? html
lgpl | 0.70 | gnu org | (?:www )?gnu org (?:licenses|copyleft) lgpl(?: \S+)? html
agpl | 0.70 | gnu org | (?:www )?gnu org licenses agpl(?: \S+)? html
gfdl | 0.70 | gnu org | (?:www )?gnu org licenses fdl(?: \S+)? html
apache-2.0 | 0.85 | apache | (?:www )?apache org licenses license 2 0(?: txt| html)?
apache-2.0 | 0.85 | apache | apache (?:software )?license (?:version |v )?v?2(?: 0)?
apache-2.0 | 0.75 | apache, apache2 | apache 2 0(?: license)?|apache2|apache 2 license
mit | 0.80 | opensource mit | (?:www )?opensource org licenses? mit(?: license)?(?: php| html)?
mit | 0.80 | mit license | (?:released|distributed|licensed) under the (?:terms of the )?mit license
bsd-3-clause | 0.80 | bsd | (?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)(?: license)?
bsd-2-clause | 0.80 | bsd, freebsd | (?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd)(?: license)?
bsd-4-clause | 0.80 | bsd | (?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd|old bsd)(?: license)?
bsd | 0.60 | bsd | bsd (?:style )?licen[cs]e
bsl-1.0 | 0.80 | boost | (?:www )?boost org license 1 0 txt
mpl-2.0 | 0.85 | mozilla | mozilla public license (?:version |v )?v?2(?: 0)?
mpl-1.1 | 0.85 | mozilla | mozilla public license (?:version |v )?v?1 1
mpl-2.0 | 0.80 | mozilla mpl | (?:www )?mozilla org (?:en us )?mpl 2 0
mpl-1.1 | 0.80 | mozilla mpl | (?:www )?mozilla org mpl (?:mpl )?1 1(?: html)?
epl-2.0 | 0.80 | eclipse | (?:www )?eclipse org legal epl (?:v20|2 0)(?: html)?
epl-1.0 | 0.80 | eclipse | (?:www )?eclipse org legal epl v10(?: html)?
unlicense | 0.85 | unlicense | (?:http |https )?unlicense org|the unlicense
isc | 0.70 | isc | isc licen[cs]e
zlib | 0.70 | zlib | zlib (?:libpng )?licen[cs]e
wtfpl | 0.80 | wtfpl | wtfpl
cc-by-4.0 | 0.90 | creative attribution | creative commons attribution 4 0(?: international)?
cc-by-3.0 | 0.90 | creative attribution | creative commons attribution 3 0(?: unported)?
cc-by-2.5 | 0.85 | creative attribution | creative commons attribution 2 5(?: generic)?
cc-by-2.0 | 0.85 | creative attribution | creative commons attribution 2 0(?: generic)?
cc-by-sa-4.0 | 0.90 | creative sharealike | creative commons attribution sharealike 4 0(?: international)?
cc-by-sa-3.0 | 0.90 | creative sharealike | creative commons attribution sharealike 3 0(?: unported)?
cc-by-nc-4.0 | 0.90 | creative noncommercial, creative commercial | creative commons attribution non ?commercial 4 0(?: international)?
cc-by-nc-3.0 | 0.90 | creative noncommercial, creative commercial | creative commons attribution non ?commercial 3 0(?: unported)?
cc-by-nd-4.0 | 0.90 | creative | creative commons attribution no ?derivatives 4 0(?: international)?
cc-by-nc-sa-4.0 | 0.90 | creative sharealike | creative commons attribution non ?commercial sharealike 4 0(?: international)?
cc-by-nc-nd-4.0 | 0.90 | creative | creative commons attribution non ?commercial no ?derivatives 4 0(?: international)?
cc-by-sa | 0.80 | creative share, creative sharealike | creative commons attribution share ?alike
cc-by-nc-sa | 0.80 | creative share, creative sharealike | creative commons attribution non ?commercial share ?alike
cc-by-nc-nd | 0.80 | creative | creative commons attribution non ?commercial no ?derivatives
cc-by-nc | 0.80 | creative | creative commons attribution non ?commercial
cc-by-nd | 0.80 | creative | creative commons attribution no ?derivatives
cc-by | 0.75 | creative | creative commons attribution
cc-by-nc-sa | 0.85 | creativecommons | creativecommons org licenses by nc sa(?: \d \d)?
cc-by-nc-nd | 0.85 | creativecommons | creativecommons org licenses by nc nd(?: \d \d)?
cc-by-nc | 0.85 | creativecommons | creativecommons org licenses by nc(?: \d \d)?
cc-by-nd | 0.85 | creativecommons | creativecommons org licenses by nd(?: \d \d)?
cc-by-sa | 0.85 | creativecommons | creativecommons org licenses by sa(?: \d \d)?
cc-by | 0.85 | creativecommons | creativecommons org licenses by(?: \d \d)?
cc0-1.0 | 0.85 | creativecommons | creativecommons org publicdomain zero 1 0
public-domain | 0.80 | creativecommons | creativecommons org publicdomain mark 1 0
cc-by-nc-sa-4.0 | 0.80 | cc by nc sa | cc by nc sa 4 0
cc-by-nc-nd-4.0 | 0.80 | cc by nc nd | cc by nc nd 4 0
cc-by-nc-4.0 | 0.80 | cc by nc | cc by nc 4 0
cc-by-nd-4.0 | 0.80 | cc by nd | cc by nd 4 0
cc-by-sa-4.0 | 0.80 | cc by sa | cc by sa 4 0
cc-by-sa-3.0 | 0.80 | cc by sa | cc by sa 3 0
cc-by-sa-2.5 | 0.80 | cc by sa | cc by sa 2 5
cc-by-sa-2.0 | 0.80 | cc by sa | cc by sa 2 0
cc-by-4.0 | 0.80 | cc by | cc by 4 0
cc-by-3.0 | 0.80 | cc by | cc by 3 0
cc-by-2.5 | 0.80 | cc by | cc by 2 5
cc-by-2.0 | 0.80 | cc by | cc by 2 0
cc-by-nc-sa | 0.70 | cc by nc sa | cc by nc sa
cc-by-nc-nd | 0.70 | cc by nc nd | cc by nc nd
cc-by-nc | 0.70 | cc by nc | cc by nc
cc-by-nd | 0.70 | cc by nd | cc by nd
cc-by-sa | 0.70 | cc by sa | cc by sa
cc0-1.0 | 0.70 | cc0 | cc0
gpl | 0.55 | gnu | gnu gpl
lgpl | 0.60 | gnu | gnu (?:lesser|library) general public license|gnu lgpl
agpl | 0.60 | gnu affero | gnu affero general public license
gfdl | 0.60 | gnu documentation | gnu free documentation license
mpl | 0.55 | mozilla | mozilla public license
epl | 0.55 | eclipse | eclipse public license
eupl | 0.55 | european | european union public licen[cs]e
ofl | 0.55 | font | open font license
artistic | 0.55 | artistic | artistic license
cddl | 0.55 | development distribution | common development and distribution license
gpl | 0.60 | gnu | gnu general public license
apache | 0.60 | apache | apache license
mit | 0.60 | mit | mit license
cc-by | 0.50 | cc by | cc by
"""

#: Identifiers: each makes a rule for the tag and one for a manifest's license field.
IDENTIFIERS = """
0bsd afl-3.0 agpl-3.0 agpl-3.0-only agpl-3.0-or-later apache-1.1 apache-2.0 artistic-1.0 artistic-2.0 blueoak-1.0.0
bsd-2-clause bsd-3-clause bsd-4-clause bsl-1.0 busl-1.1 cc-by-3.0 cc-by-4.0 cc-by-nc-4.0 cc-by-nc-nd-4.0
cc-by-nc-sa-4.0 cc-by-nd-4.0 cc-by-sa-3.0 cc-by-sa-4.0 cc0-1.0 cddl-1.0 cddl-1.1 cecill-2.1 cecill-b cecill-c cpl-1.0
ecl-2.0 elastic-2.0 epl-1.0 epl-2.0 eupl-1.1 eupl-1.2 gfdl-1.3 gpl-1.0 gpl-2.0 gpl-2.0-only gpl-2.0-or-later gpl-3.0
gpl-3.0-only gpl-3.0-or-later isc lgpl-2.0 lgpl-2.1 lgpl-2.1-only lgpl-2.1-or-later lgpl-3.0 lgpl-3.0-only
lgpl-3.0-or-later mit mit-0 mpl-1.1 mpl-2.0 ms-pl ms-rl mulanpsl-2.0 ncsa odbl-1.0 ofl-1.1 openssl osl-3.0 php-3.01
postgresql python-2.0 ruby sspl-1.0 unlicense upl-1.0 vim w3c wtfpl x11 zlib
"""


def table() -> list[tuple[str, float, tuple[frozenset[str], ...], str]]:
    """(label, weight, sets of keywords, regex) of every rule, first things first."""

    def read(lines: str):
        for line in lines.strip().splitlines():
            label, weight, keys, regex = (x.strip() for x in line.split(" | ", 3))
            yield label, float(weight), tuple(frozenset(k.split()) for k in keys.split(",")), regex

    tags = []
    for name in IDENTIFIERS.split():
        words = name.replace("-", " ").replace(".", " ")
        tags.append((name, 0.99, (frozenset({"spdx"}),), f"spdx license identifier (?:\\S+ (?:or|and) )?{words}(?= |$)(?! (?:only|or later))"))
        tags.append((name, 0.80, (frozenset({"license"}),), f"license {words}(?= (?:author|version|dependencies|main|scripts|description|homepage))"))
    return [*tags[::2], *read(NOTICES), *read(FURTHER), *tags[1::2], *read(NAMES)]
