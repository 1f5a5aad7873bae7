"""Signature rules of the license scan, in order.

A line is ``priority label : keywords : expression``. Expressions match whole
words of a text that is lower-cased and whose words are joined by single
spaces, so ``apache license 2 0`` stands for "Apache-License, 2.0". A rule
runs only on texts that hold each of its keywords (``a/b``: either one).
``{1}`` in a label is the expression's first group, blanks turned into dots.
Gaps have a fixed length, so that matching takes linear time.

Priorities: 5 passages of license texts, 4 tags and notices that name a
version, 3 names with a version, 2 names and addresses, 1 hints.
"""

RULES = r"""
# GNU licenses: texts and notices
5 gpl-2.0 : gnu modify : you can redistribute it and or modify (?:\S+ ){0,12}gnu general public license as published by the free software foundation either version 2 of the license(?! or)
5 gpl-2.0-or-later : free modify : redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or (?:\S+ ){0,4}any later version
5 gpl-3.0-or-later : free modify : redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or (?:\S+ ){0,4}any later version
5 lgpl-2.1-or-later : lesser modify : redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or (?:\S+ ){0,4}any later version
5 lgpl-3.0-or-later : lesser modify : redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or (?:\S+ ){0,4}any later version
5 lgpl-2.0-or-later : library modify : redistribute it and or modify it under the terms of the gnu library general public license as published by the free software foundation either version 2 of the license or (?:\S+ ){0,4}any later version
5 agpl-3.0-or-later : affero modify : redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or (?:\S+ ){0,4}any later version
5 gpl : gnu copyleft : the gnu general public license is a free copyleft license for software and other kinds of works
5 gpl : freedom away : the licenses for most software are designed to take away your freedom to share and change it
5 agpl-3.0 : affero copyleft : the gnu affero general public license is a free copyleft license for software and other kinds of works
5 lgpl-3.0 : lesser incorporates : this version of the gnu lesser general public license incorporates the terms and conditions of version 3 of the gnu general public license
5 gfdl : documentation modify : permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
5 gpl : warranty gnu : without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details
5 lgpl : warranty lesser : without even the implied warranty of merchantability or fitness for a particular purpose see the gnu lesser general public license for more details
5 agpl : warranty affero : without even the implied warranty of merchantability or fitness for a particular purpose see the gnu affero general public license for more details
5 gpl : along gnu : you should have received a copy of the gnu general public license along with
5 lgpl : along lesser/library : you should have received a copy of the gnu (?:lesser|library) general public license along with
5 agpl : along affero : you should have received a copy of the gnu affero general public license along with
5 classpath-exception : linking statically : linking this library statically or dynamically with other modules is making a combined work based on this library
5 gcc-exception : runtime exception : gcc runtime library exception
5 autoconf-exception : autoconf configuration : configuration script generated by autoconf you may include it under the same distribution terms
# GNU licenses: tags, notices, names
4 gpl-1.0-or-later : gpl spdx : spdx license identifier gpl 1 0 or later
4 gpl-1.0-only : gpl spdx : spdx license identifier gpl 1 0(?: only)?(?! or)
4 gpl-2.0-or-later : gpl spdx : spdx license identifier gpl 2 0 or later
4 gpl-2.0-only : gpl spdx : spdx license identifier gpl 2 0(?: only)?(?! or)
4 gpl-3.0-or-later : gpl spdx : spdx license identifier gpl 3 0 or later
4 gpl-3.0-only : gpl spdx : spdx license identifier gpl 3 0(?: only)?(?! or)
4 lgpl-{1}-or-later : lgpl spdx : spdx license identifier lgpl (2 0|2 1|3 0) or later
4 lgpl-{1}-only : lgpl spdx : spdx license identifier lgpl (2 0|2 1|3 0)(?: only)?(?! or)
4 agpl-{1}-or-later : agpl spdx : spdx license identifier agpl (1 0|3 0) or later
4 agpl-{1}-only : agpl spdx : spdx license identifier agpl (1 0|3 0)(?: only)?(?! or)
4 gfdl-{1} : gfdl spdx : spdx license identifier gfdl (1 1|1 2|1 3)(?: only| or later)?
4 gpl-{1}.0-or-later : gnu later : gnu general public licen[cs]e (?:version |v ?)([123])(?: 0)? or (?:\S+ ){0,3}(?:any )?later(?: version)?
4 gpl-{1}.0-or-later : gpl later : (?:gnu )?gpl (?:version |v ?)?([123])(?: 0)? or (?:\S+ ){0,3}(?:any )?later(?: version)?
4 gpl-{1}.0-or-later : later gplv1/gplv2/gplv3 : gplv([123]) or (?:\S+ ){0,3}(?:any )?later
3 gpl-{1}.0 : gnu general public : gnu general public licen[cs]e (?:version |v ?)?([123])(?: 0)?
3 gpl-{1}.0 : gnu v1/v2/v3 : gnu general public licen[cs]e v([123])
3 gpl-{1}.0 : gpl : (?:gnu )?gpl (?:version |v )([123])(?: 0)?
3 gpl-{1}.0 : gpl : (?:gnu )?gpl ([123]) 0
3 gpl-{1}.0 : gplv1/gplv2/gplv3 : (?:gnu )?gplv([123])(?: 0)?
3 lgpl-2.1 : lesser gnu : gnu lesser general public licen[cs]e (?:version |v ?)?2 1
3 lgpl-3.0 : lesser gnu : gnu lesser general public licen[cs]e (?:version |v ?)?3(?: 0)?
3 lgpl-2.0 : library gnu : gnu library general public licen[cs]e (?:version |v ?)?2(?: 0)?
3 lgpl-{1} : lgpl : (?:gnu )?lgpl (?:version |v ?)?(2 0|2 1|3 0)
3 lgpl-2.1 : lgplv2 : (?:gnu )?lgplv2 1
3 lgpl-{1}.0 : lgplv2/lgplv3 : (?:gnu )?lgplv([23])(?: 0)?
3 agpl-3.0 : affero gnu : gnu affero general public licen[cs]e (?:version |v ?)?3(?: 0)?
3 agpl-3.0 : agpl : (?:gnu )?agpl (?:version |v ?)?3(?: 0)?
3 agpl-3.0 : agplv3 : (?:gnu )?agplv3
3 gfdl-{1} : documentation gnu : gnu free documentation licen[cs]e (?:version |v ?)?(1 [123])
2 gpl : gnu general public : gnu general public licen[cs]e
2 gpl : gnu gpl : gnu gpl
2 gpl : gnu copyleft : gnu org copyleft gpl html
2 gpl : gnu licenses : gnu org licenses(?: old licenses)?(?: gpl \S+| gpl)
2 gpl : gpl license/licence/licensed : (?:gpl licen[cs]e|licensed under (?:the )?gpl)
2 lgpl : lesser gnu : gnu lesser general public licen[cs]e
2 lgpl : library gnu : gnu library general public licen[cs]e
2 lgpl : lgpl gnu/license/licence/licensed : (?:gnu lgpl|lgpl licen[cs]e|licensed under (?:the )?lgpl)
2 lgpl : gnu lgpl : gnu org licenses lgpl(?: html)?
2 agpl : affero gnu : gnu affero general public licen[cs]e
2 agpl : affero : affero general public licen[cs]e
2 agpl : agpl gnu/license/licence/licensed : (?:gnu agpl|agpl licen[cs]e|licensed under (?:the )?agpl)
2 gfdl : documentation gnu : gnu free documentation licen[cs]e
# Apache
5 apache-2.0 : apache compliance : licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license
5 apache-2.0 : apache obtain : you may obtain a copy of the license at (?:https? )?(?:www )?apache org licenses license 2 0
5 apache-2.0 : as basis warranties conditions : unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind
5 apache-2.0 : perpetual irrevocable : grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright|except as stated in this section patent) license
5 apache-1.1 : apache developed : this product includes software developed by the apache software foundation
4 apache-{1} : apache spdx : spdx license identifier apache (1 0|1 1|2 0)
4 apache-2.0 : apache under : under (?:the )?(?:terms of )?(?:the )?apache(?: software)? licen[cs]e (?:version |v ?)?2(?: 0)?
3 apache-{1} : apache license/licence : apache(?: software)? licen[cs]e (?:version |v ?)?(1 0|1 1|2 0)
3 apache-2.0 : apache v2 : apache(?: software)?(?: licen[cs]e)? v2(?: 0)?
3 apache-2.0 : apache : apache 2 0(?: licen[cs]ed?)?
3 apache-2.0 : apache asl : apache asl 2(?: 0)?
2 apache : apache license/licence : apache(?: software)? licen[cs]e
2 apache : apache licensed : apache licensed
2 apache : apache licenses : apache org licenses
# MIT and relatives
5 mit : charge obtaining : permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
5 mit : deal restriction : to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software
5 mit : permission substantial : the above copyright notice and this permission notice (?:\S+ )?shall be included in all copies or substantial portions of the software
5 mit : noninfringement merchantability : the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement
5 x11 : consortium advertising : except as contained in this notice the name of the x consortium shall not be used in advertising
4 mit-0 : mit spdx : spdx license identifier mit 0
4 mit : mit spdx : spdx license identifier mit(?! 0)
4 x11 : x11 spdx : spdx license identifier x11
4 mit : mit under : (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?(?:expat )?mit licen[cs]e
3 mit-0 : mit attribution : mit no attribution(?: licen[cs]e)?
3 mit : expat : (?:expat mit|mit expat|expat)(?: licen[cs]e)
3 mit : mit style : mit style licen[cs]e
3 x11 : x11 license/licence : (?:mit )?x11 licen[cs]e
2 mit : mit license/licence : mit licen[cs]e
2 mit : mit licensed : mit licensed
2 mit : mit licenses : opensource org licenses mit(?: license)?(?: php| html)?
# BSD and relatives
5 bsd : redistribution permitted : redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
5 bsd-3-clause : endorse neither : neither the name of (?:\S+ ){1,12}nor the names of (?:its|any|their) (?:\S+ ){0,3}contributors may be used to endorse or promote products
5 bsd-4-clause : advertising mentioning : all advertising materials mentioning features or use of this software must display the following acknowledge?ment
5 bsd : express implied : this software is provided by the (?:\S+ ){1,8}as is and any express or implied warranties
5 0bsd : fee hereby : permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted(?! provided)
5 isc : fee provided : permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice
5 ntp : fee documentation : permission to use copy modify and distribute this software and its documentation for any purpose with or without fee is hereby granted
4 bsd-{1}-clause : bsd spdx : spdx license identifier bsd ([1234]) clause(?! (?:patent|clear|lbnl))
4 bsd-2-clause-patent : patent spdx : spdx license identifier bsd 2 clause patent
4 bsd-3-clause-clear : clear spdx : spdx license identifier bsd 3 clause clear
4 bsd-3-clause-lbnl : lbnl spdx : spdx license identifier bsd 3 clause lbnl
4 0bsd : 0bsd spdx : spdx license identifier 0bsd
4 isc : isc spdx : spdx license identifier isc
3 bsd-{1}-clause : bsd clause : bsd ([1234]) clause(?: licen[cs]e)?
3 bsd-{1}-clause : bsd clause : ([1234]) clause bsd(?: style)?(?: licen[cs]e)?
3 bsd-2-clause : simplified/freebsd : (?:simplified bsd|freebsd) licen[cs]e
3 bsd-3-clause : bsd new/modified/revised : (?:new|modified|revised) bsd licen[cs]e
3 bsd-3-clause : bsd three : three clause bsd(?: licen[cs]e)?
3 bsd-2-clause : bsd two : two clause bsd(?: licen[cs]e)?
3 bsd-4-clause : bsd original/old : (?:original|old) bsd licen[cs]e
3 0bsd : zero bsd : zero clause bsd(?: licen[cs]e)?
2 bsd : bsd license/licence/licensed : bsd(?: style)? (?:licen[cs]e|licensed)
2 bsd : bsd licenses : opensource org licenses bsd license
2 isc : isc license/licence : isc licen[cs]e
2 ntp : ntp license/licence : ntp licen[cs]e
2 hpnd : historical notice : historical permission notice and disclaimer
# Creative Commons
5 cc-by-{1} : creative attribution : creative commons attribution (?:international public licen[cs]e )?(?:version |v ?)?([1234] [05]) (?:international )?public licen[cs]e
5 cc0-1.0 : deed dedicated : the person who associated a work with this deed has dedicated the work to the public domain
5 cc0-1.0 : affirmer waives : affirmer hereby overtly fully permanently irrevocably and unconditionally waives
5 cc : exercising creative : by exercising the licensed rights you accept and agree to be bound by the terms and conditions of this creative commons
4 cc0-1.0 : cc0 spdx : spdx license identifier cc0 1 0
4 cc-by-{1} : cc spdx by : spdx license identifier cc by ([1234] [05])
4 cc-by-sa-{1} : cc spdx sa : spdx license identifier cc by sa ([1234] [05])
4 cc-by-nd-{1} : cc spdx nd : spdx license identifier cc by nd ([1234] [05])
4 cc-by-nc-{1} : cc spdx nc : spdx license identifier cc by nc ([1234] [05])
4 cc-by-nc-sa-{1} : cc spdx nc : spdx license identifier cc by nc sa ([1234] [05])
4 cc-by-nc-nd-{1} : cc spdx nc : spdx license identifier cc by nc nd ([1234] [05])
4 cc-by-{1} : creativecommons by : creativecommons org licenses by ([1234] [05])
4 cc-by-sa-{1} : creativecommons sa : creativecommons org licenses by sa ([1234] [05])
4 cc-by-nd-{1} : creativecommons nd : creativecommons org licenses by nd ([1234] [05])
4 cc-by-nc-{1} : creativecommons nc : creativecommons org licenses by nc ([1234] [05])
4 cc-by-nc-sa-{1} : creativecommons nc sa : creativecommons org licenses by nc sa ([1234] [05])
4 cc-by-nc-nd-{1} : creativecommons nc nd : creativecommons org licenses by nc nd ([1234] [05])
4 cc0-1.0 : creativecommons zero : creativecommons org publicdomain zero 1 0
4 cc-pdm-1.0 : creativecommons mark : creativecommons org publicdomain mark 1 0
3 cc-by-{1} : cc by : cc by ([1234] [05])
3 cc-by-sa-{1} : cc by sa : cc by sa ([1234] [05])
3 cc-by-nd-{1} : cc by nd : cc by nd ([1234] [05])
3 cc-by-nc-{1} : cc by nc : cc by nc ([1234] [05])
3 cc-by-nc-sa-{1} : cc by nc sa : cc by nc sa ([1234] [05])
3 cc-by-nc-nd-{1} : cc by nc nd : cc by nc nd ([1234] [05])
3 cc0-1.0 : cc0 : cc0(?: 1 0)?(?: universal)?
3 cc-by-{1} : creative attribution : creative commons attribution(?: licen[cs]e)? ([1234] [05])
3 cc-by-sa-{1} : creative alike/sharealike : creative commons attribution share ?alike(?: licen[cs]e)? ([1234] [05])
3 cc-by-nd-{1} : creative noderivatives/derivatives/noderivs/derivs : creative commons attribution no ?deriv(?:ative)?s(?: licen[cs]e)? ([1234] [05])
3 cc-by-nc-{1} : creative noncommercial/commercial : creative commons attribution non ?commercial(?: licen[cs]e)? ([1234] [05])
3 cc-by-nc-sa-{1} : creative noncommercial/commercial alike/sharealike : creative commons attribution non ?commercial share ?alike(?: licen[cs]e)? ([1234] [05])
3 cc-by-nc-nd-{1} : creative noncommercial/commercial noderivatives/derivatives/noderivs/derivs : creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: licen[cs]e)? ([1234] [05])
2 cc-by-sa : cc by sa : cc by sa
2 cc-by-nd : cc by nd : cc by nd
2 cc-by-nc : cc by nc : cc by nc(?! (?:sa|nd))
2 cc-by-nc-sa : cc by nc sa : cc by nc sa
2 cc-by-nc-nd : cc by nc nd : cc by nc nd
2 cc-by : cc by : cc by
2 cc-by : creative attribution : creative commons attribution(?: licen[cs]e)?
2 cc : creative commons license/licence/licensed : (?:creative commons licen[cs]e|licensed under (?:a |the )?creative commons)
2 cc : creativecommons : creativecommons org
# Mozilla, Eclipse, Sun, IBM, European Union
5 mpl-2.0 : mozilla form : this source code form is subject to the terms of the mozilla public license v 2 0
5 mpl-1.1 : mozilla contents : the contents of this file are subject to the mozilla public license version 1 1
5 cddl-1.0 : contents development : the contents of this file are subject to the terms of the common development and distribution license
5 epl-1.0 : eclipse accompanying : this program and the accompanying materials are made available under the terms of the eclipse public license v1 0
5 epl-2.0 : eclipse accompanying : this program and the accompanying materials are made available under the terms of the eclipse public license (?:v |v)?2 0
5 eupl : eupl licensed : licensed under the eupl
4 mpl-{1} : mpl spdx : spdx license identifier mpl (1 0|1 1|2 0)
4 epl-{1} : epl spdx : spdx license identifier epl (1 0|2 0)
4 cddl-{1} : cddl spdx : spdx license identifier cddl (1 0|1 1)
4 cpl-1.0 : cpl spdx : spdx license identifier cpl 1 0
4 ipl-1.0 : ipl spdx : spdx license identifier ipl 1 0
4 eupl-{1} : eupl spdx : spdx license identifier eupl (1 [012])
3 mpl-{1} : mozilla license/licence : mozilla public licen[cs]e (?:version |v ?)?(1 0|1 1|2 0)
3 mpl-{1} : mpl : mpl (?:version |v ?)?(1 0|1 1|2 0)
3 epl-{1} : eclipse license/licence : eclipse public licen[cs]e (?:version |v ?)?(1 0|2 0)
3 epl-{1} : epl : epl (?:version |v ?)?(1 0|2 0)
3 cddl-{1} : cddl : cddl (?:version |v ?)?(1 0|1 1)
3 eupl-{1} : eupl : eupl (?:version |v ?)?(1 [012])
3 eupl-{1} : european union : european union public licen[cs]e (?:version |v ?)?(1 [012])
2 mpl : mozilla license/licence : mozilla public licen[cs]e
2 mpl : mozilla mpl : mozilla org mpl
2 epl : eclipse license/licence : eclipse public licen[cs]e
2 edl-1.0 : eclipse distribution : eclipse distribution licen[cs]e
2 cddl : common development : common development and distribution licen[cs]e
2 cpl-1.0 : common license/licence : common public licen[cs]e
2 ipl-1.0 : ibm license/licence : ibm public licen[cs]e
2 spl-1.0 : sun license/licence : sun public licen[cs]e
2 npl : netscape license/licence : netscape public licen[cs]e
2 eupl : european union : european union public licen[cs]e
# Languages, tools, libraries
5 zlib : misrepresented origin : the origin of this software must not be misrepresented you must not claim that you wrote the original software
5 bsl-1.0 : charge organization : permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
5 unlicense : unencumbered public : this is free and unencumbered software released into the public domain
5 wtfpl : fuck : do what the fuck you want to(?: public licen[cs]e)?
5 beerware : beer : if we meet some day and you think this stuff is worth it you can buy me a beer
5 json : evil good : the software shall be used for good not evil
5 ofl-1.1 : font sil : this font software is licensed under the sil open font license version 1 1
5 openssl : openssl toolkit : this product includes software developed by the openssl project for use in the openssl toolkit
5 unicode : unicode files : permission is hereby granted free of charge to any person obtaining a copy of the unicode data files
5 psf-2.0 : psf licensee : psf hereby grants licensee a nonexclusive royalty free world wide license
5 lppl : latex modified : this work may be distributed and or modified under the conditions of the latex project public license
5 sleepycat : redistributions accompanied : redistributions in any form must be accompanied by information on how to obtain complete source code
4 artistic-{1} : artistic spdx : spdx license identifier artistic (1 0|2 0)(?: perl)?
4 zlib : zlib spdx : spdx license identifier zlib
4 bsl-1.0 : bsl spdx : spdx license identifier bsl 1 0
4 unlicense : unlicense spdx : spdx license identifier unlicense
4 wtfpl : wtfpl spdx : spdx license identifier wtfpl
4 psf-2.0 : python/psf spdx : spdx license identifier (?:python|psf) 2 0
4 ofl-1.1 : ofl spdx : spdx license identifier ofl 1 1
4 ms-{1} : ms spdx : spdx license identifier ms (pl|rl)
4 ncsa : ncsa spdx : spdx license identifier ncsa
4 postgresql : postgresql spdx : spdx license identifier postgresql
4 openssl : openssl spdx : spdx license identifier openssl
4 curl : curl spdx : spdx license identifier curl
4 afl-{1} : afl spdx : spdx license identifier afl ([123] [01])
4 osl-{1} : osl spdx : spdx license identifier osl ([123] [01])
4 ecl-{1} : ecl spdx : spdx license identifier ecl ([12] 0)
4 qpl-1.0 : qpl spdx : spdx license identifier qpl 1 0
4 cecill-{1} : cecill spdx : spdx license identifier cecill (1 0|1 1|2 0|2 1|b|c)
3 artistic-{1} : artistic license/licence : artistic licen[cs]e (?:version |v ?)?(1 0|2 0)
3 ofl-1.1 : font sil : sil open font licen[cs]e (?:version |v ?)?1 1
3 afl-{1} : academic license/licence : academic free licen[cs]e (?:version |v ?)?([123] [01])
3 osl-{1} : open license/licence : open software licen[cs]e (?:version |v ?)?([123] [01])
3 ecl-{1} : educational license/licence : educational community licen[cs]e (?:version |v ?)?([12] 0)
3 bsl-1.0 : boost license/licence : boost software licen[cs]e (?:version |v ?)?1 0
3 lppl-{1} : lppl : lppl (?:version |v ?)?(1 [0123][abc]?)
3 cecill-{1} : cecill : cecill (?:version |v ?)?(2 0|2 1|b|c)
2 artistic : artistic license/licence : artistic licen[cs]e
2 perl : perl same : (?:under )?the same terms as perl(?: itself)?
2 psf : python license/licence : python(?: software foundation)? licen[cs]e
2 php : php license/licence : php licen[cs]e
2 ruby : ruby license/licence : ruby licen[cs]e
2 zlib : zlib license/licence : zlib(?: libpng)? licen[cs]e
2 libpng : libpng license/licence : libpng licen[cs]e
2 bsl-1.0 : boost license/licence : boost software licen[cs]e
2 bsl-1.0 : boost license : boost org license 1 0(?: txt)?
2 unlicense : unlicense : (?:the unlicense|unlicense org)
2 wtfpl : wtfpl : wtfpl
2 beerware : beerware/beer license/licence : beer ?ware licen[cs]e
2 ofl : font sil : sil open font licen[cs]e
2 ms-pl : microsoft license/licence : microsoft public licen[cs]e
2 ms-rl : microsoft reciprocal : microsoft reciprocal licen[cs]e
2 apsl : apple license/licence : apple public source licen[cs]e
2 qpl : qt/q license/licence : (?:qt|q) public licen[cs]e
2 ncsa : illinois/ncsa license/licence : (?:university of illinois )?ncsa(?: open source)? licen[cs]e
2 postgresql : postgresql license/licence : postgresql licen[cs]e
2 openssl : openssl license/licence : openssl licen[cs]e
2 icu : icu license/licence : icu licen[cs]e
2 w3c : w3c license/licence : w3c software(?: notice)?(?: and)?(?: document)? licen[cs]e
2 afl : academic license/licence : academic free licen[cs]e
2 osl : open license/licence : open software licen[cs]e
2 lppl : latex license/licence : latex project public licen[cs]e
2 vim : vim license/licence : vim licen[cs]e
2 sleepycat : sleepycat license/licence : sleepycat licen[cs]e
2 cecill : cecill license/licence : cecill(?: free software)? licen[cs]e
2 json : json license/licence : json licen[cs]e
# Data, models, source-available
5 odbl-1.0 : database open : open database license odbl
5 sspl-1.0 : sspl/server side : server side public licen[cs]e
5 commons-clause : grant sell : the license does not grant to you the right to sell the software
4 {1}-1.0 : spdx odbl/pddl : spdx license identifier (odbl|pddl) 1 0
4 odc-by-1.0 : odc spdx : spdx license identifier odc by 1 0
4 cdla-permissive-{1} : cdla spdx : spdx license identifier cdla permissive ([12] 0)
4 cdla-sharing-1.0 : cdla spdx : spdx license identifier cdla sharing 1 0
4 busl-1.1 : busl spdx : spdx license identifier busl 1 1
4 elastic-2.0 : elastic spdx : spdx license identifier elastic 2 0
3 odbl-1.0 : database license/licence : open database licen[cs]e(?: odbl)?(?: v ?1 0| 1 0)?
3 odc-by-1.0 : odc by : odc by(?: v ?1 0| 1 0)?
3 busl-1.1 : business license/licence : business source licen[cs]e (?:version |v ?)?1 1
3 elastic-2.0 : elastic license/licence : elastic licen[cs]e (?:version |v ?)?2(?: 0)?
3 polyform-{1} : polyform : polyform (noncommercial|shield|strict|perimeter)(?: licen[cs]e)?
3 ogl-uk-{1} : government open : open government licen[cs]e (?:version |v ?)?([123] 0)
2 odbl : odbl : odbl
2 pddl-1.0 : domain dedication : public domain dedication and licen[cs]e
2 cdla : community data : community data licen[cs]e agreement
2 ogl : government open : open government licen[cs]e
2 busl : business license/licence : business source licen[cs]e
2 elastic : elastic license/licence : elastic licen[cs]e
2 commons-clause : commons clause : commons clause(?: licen[cs]e)?(?: condition)?
2 openrail : openrail/rail : (?:creativeml )?open ?rail(?: m)?
2 openrail : bigscience bloom : bigscience bloom rail(?: 1 0)?
2 llama : llama community : llama (?:[23] )?(?:[123] )?community licen[cs]e(?: agreement)?
2 gemma : gemma terms : gemma terms of use
2 fair-source : fair source : fair source licen[cs]e
2 fal : art/libre : (?:free art licen[cs]e|licence art libre)
# Hints
1 public-domain : public domain : (?:released|placed|dedicated|is|are|in|into) (?:in |into |to )?the public domain
1 all-rights-reserved : rights reserved : all rights reserved
1 proprietary : proprietary confidential : (?:proprietary and confidential|confidential and proprietary)
1 proprietary : unauthorized copying : unauthorized copying of this (?:file|document|material|work)
1 non-commercial : commercial use/purposes : for non commercial (?:use|purposes) only
1 non-commercial : noncommercial use/purposes : for noncommercial (?:use|purposes) only
1 permission-required : permission without : (?:may not be reproduced|no part of this) (?:\S+ ){1,30}without (?:the )?(?:prior )?(?:written |express )?permission
1 copyleft : copyleft : copyleft
1 royalty-free : royalty license/licence : royalty free licen[cs]e
1 see-license : see license/licence : see (?:the )?licen[cs]e(?: file)? for (?:details|more information|terms)
1 open-source : open source license/licence : (?:an |this )?open source licen[cs]e
"""
