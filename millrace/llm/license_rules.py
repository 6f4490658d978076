r"""Signature rules of license texts, in order of precedence within a level.

Rules read words as ``licenses.normalised`` leaves them: A to Z lower-cased, words joined by single
spaces, so "BSD 3-Clause" reads ``bsd 3 clause``. A rule is a line ``label | words it needs | regex``. The needed
words are the keyword prefilter: of each group of alternatives (``one/other``) one must stand in the
text. Regexes hold no construct that reads more than a bounded number of words, and stand for whole
words. A label of ``-`` shields: what such a match contains is no license.
"""

from __future__ import annotations

import re

# Levels: lower ones win over what they contain. The number is the confidence of a match.
BASE, NOTICE, TAG, NAME, HINT = range(5)
CONFIDENCE = {BASE: 1.0, NOTICE: 0.98, TAG: 0.95, NAME: 0.9, HINT: 0.6}

# The phrases that are always reported, and their labels.
PHRASES = """
mit | mit license | under the mit license
apache-2 | apache license | apache license version 2
cc-by-nc | cc nc | cc by nc
"""

NOTICES = r"""
mit | permission granted/hereby merge/sublicense | permission is hereby granted free of charge to any person obtaining a copy( of this software)?
mit | without restriction merge | without restriction including without limitation the rights to use copy modify merge publish distribute sublicense
mit | copyright permission substantial | above copyright notice and this permission notice shall be included in all copies or substantial portions
mit-0 | permission merge sell | to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided
isc | permission purpose | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted( provided)?
0bsd | permission purpose | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software
hpnd | permission purpose | permission to use copy modify and distribute this software and its documentation for any purpose( and without fee)? is hereby granted
bsd-2 | redistribution binary | redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation
bsd-3 | endorse promote | neither the names? of \S+( \S+){0,8} nor the names of( its)?( the)? contributors may be used to endorse or promote products
bsd-4 | advertising materials | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
bsd | redistribution binary | redistribution and use in source and binary forms with or without modification are permitted( provided)?
apache-2 | apache compliance | you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0
apache-2 | apache license | licensed under the apache license version 2 0( the license)?
apache-2 | terms reproduction | terms and conditions for use reproduction and distribution 1 definitions license shall mean
apache-1.1 | apache acknowledgment/acknowledgement | this product includes software developed by the apache software foundation
gpl | redistribute gnu | redistribute it and or modify it under the terms of the gnu general public license
gpl-2 | redistribute gnu foundation 2 | gnu general public license as published by the free software foundation either version 2 of the license
gpl-2 | redistribute gnu foundation 2 | gnu general public license version 2 as published by the free software foundation
gpl-3 | redistribute gnu foundation 3 | gnu general public license as published by the free software foundation either version 3 of the license
gpl-1 | redistribute gnu foundation 1 | gnu general public license as published by the free software foundation either version 1
lgpl | redistribute gnu lesser/library | redistribute it and or modify it under the terms of the gnu (lesser|library) general public license
lgpl-2 | gnu foundation library 2 | gnu library general public license as published by the free software foundation either version 2
lgpl-2.1 | gnu foundation lesser 2 | gnu lesser general public license as published by the free software foundation either version 2 1
lgpl-3 | gnu foundation lesser 3 | gnu lesser general public license as published by the free software foundation either version 3
agpl-3 | gnu foundation affero | gnu affero general public license as published by( the free software foundation)? either version 3
agpl | gnu affero | redistribute it and or modify it under the terms of the gnu affero general public license
gfdl | permission invariant | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
gfdl | invariant sections texts | with no invariant sections( with)? no front cover texts and( with)? no back cover texts
gpl-3 | program warranty gnu | this program comes with absolutely no warranty( for details type show w)? this is free software and you are welcome to redistribute it
mpl-1.1 | mozilla contents | the contents of this file are subject to the mozilla public license version 1 1
mpl-1 | mozilla contents | the contents of this file are subject to the mozilla public license version 1 0
mpl-2 | mozilla source | this source code form is subject to the terms of the mozilla public license v(ersion)? ?2 0
npl-1.1 | netscape contents | the contents of this file are subject to the netscape public license version 1 1
cddl-1 | common development | subject to the terms of the common development and distribution license( version 1 0)?( the license)?
cpl-1 | common accompanying | this program and the accompanying materials are made available under the terms of the common public license v1 0
epl-1 | eclipse accompanying | this program and the accompanying materials are made available under the terms of the eclipse public license v1 0
epl-2 | eclipse accompanying | this program and the accompanying materials are made available under the terms of the eclipse public license( v)? ?2 0
ms-pl | microsoft public accompanying | this license governs use of the accompanying software if you use the software you accept this license
artistic-1 | artistic intent | the intent of this document is to state the conditions under which a package may be copied
artistic-2 | artistic permitted | everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed preamble this license establishes the terms
zlib | implied origin misrepresented | the origin of this software must not be misrepresented you must not claim that you wrote the original software
zlib | altered plainly | altered source versions must be plainly marked as such and must not be misrepresented as being the original software
libpng | png reference contributing | the png reference library is supplied as is the contributing authors
boost-1 | boost distributed | distributed under the boost software license version 1 0
boost-1 | machine executable derivative | unless such copies or derivative works are solely in the form of machine executable object code generated by a source language processor
unlicense | unencumbered domain | this is free and unencumbered software released into the public domain
cc0-1 | waived copyright related | has waived all copyright and related or neighboring rights to this work
wtfpl | fuck want | you just do what the fuck you want to
beerware | beer buy | you can buy me a beer in return
python-2 | python psf | psf hereby grants licensee a nonexclusive royalty free world wide license
postgresql | postgresql permission | in no event shall the university of california be liable to any party for direct indirect special incidental or consequential damages
openssl | openssl toolkit | this product includes software developed by the openssl project for use in the openssl toolkit
ssleay | eric young | this product includes cryptographic software written by eric young
x11 | consortium advertising | except as contained in this notice the name of the x consortium shall not be used in advertising
curl | permission purpose copyright | permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice
ncsa | illinois open | university of illinois ncsa open source license
w3c | w3c obtaining | by obtaining( using)? and or copying this work you the licensee agree that you have read understood and will comply
unicode | unicode data permission | permission is hereby granted free of charge to any person obtaining a copy of the unicode data files
ofl-1.1 | font sil | this font software is licensed under the sil open font license version 1 1
json | good evil | the software shall be used for good not evil
elastic-2 | hosted managed | you may not provide the software to third parties as a hosted or managed service
sspl-1 | program service server | if you make the functionality of the program or a modified version available to third parties as a service
bsl-1.1 | licensor production | the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work
commons-clause | commons clause | the grant of rights under the license will not include and the license does not grant to you the right to sell the software
cc-by-4 | creative attribution 4 | this work is licensed under( a| the)? creative commons attribution 4 0 international( public)? license
cc-by-3 | creative attribution 3 | this work is licensed under( a| the)? creative commons attribution 3 0( unported)? license
cc-by-sa-4 | creative attribution sharealike/alike | this work is licensed under( a| the)? creative commons attribution share ?alike 4 0 international( public)? license
cc-by-nc | creative noncommercial/commercial | this work is licensed under( a| the)? creative commons attribution non ?commercial [1-4] [05]( \S+)? license
cc-by-nc-sa | creative noncommercial/commercial sharealike/alike | this work is licensed under( a| the)? creative commons attribution non ?commercial share ?alike [1-4] [05]( \S+)? license
cc-by-nc-nd | creative noncommercial/commercial noderivatives/noderivs/derivatives | this work is licensed under( a| the)? creative commons attribution non ?commercial no ?deriv(ative)?s( works)? [1-4] [05]( \S+)? license
cc-by-nd | creative noderivatives/noderivs/derivatives | this work is licensed under( a| the)? creative commons attribution no ?deriv(ative)?s( works)? [1-4] [05]( \S+)? license
proprietary | confidential proprietary | this (software|document|material|information) is (the )?(confidential and proprietary|proprietary and confidential)( information)?
proprietary | unauthorized copying | unauthorized copying( of this file)?( via any medium)? is strictly prohibited
proprietary | reproduced permission | (no part of|may not be) \S+( \S+){0,6} reproduced( \S+){0,10} without( the)?( prior)?( express)?( written)? permission
"""

NAMES = r"""
mit | mit license/licence/licensed | (under|use|uses|is|as)( the| an| a)?( terms of)?( the)? mit( x11)? (open source )?(license|licence)
mit | mit licensed | mit licensed
mit | expat license/licence | expat (mit )?(license|licence)
mit-0 | mit attribution | mit no attribution( license)?
x11 | x11 license/licence | x11 (license|licence)
mit | mit license/licence | mit( style| expat| x11)? (license|licence)
isc | isc license/licence | isc (license|licence)
isc | internet consortium license | internet (software|systems) consortium license
0bsd | 0bsd | 0bsd
0bsd | bsd zero clause | bsd zero clause( license)?
bsd-2 | bsd 2 clause | (bsd 2 clause|2 clause bsd)( (simplified|freebsd))?( (license|licence))?
bsd-2 | simplified/freebsd bsd license | (simplified|freebsd) bsd license
bsd-2 | freebsd license | freebsd license
bsd-3 | bsd 3 clause | (bsd 3 clause|3 clause bsd)( (new|revised|modified))?( (license|licence))?
bsd-3 | bsd new/revised/modified | (new|revised|modified) bsd (license|licence)
bsd-4 | bsd 4 clause | (bsd 4 clause|4 clause bsd)( (license|licence))?
bsd-4 | original bsd license | original bsd license
bsd-3-clear | clear bsd license | clear bsd( 3 clause)? license
bsd-protection | bsd protection | bsd protection license
bsd | bsd license/licence/licensed | bsd( style| type| like)? (license|licence|licensed)
bsd | berkeley license | berkeley( software distribution)? (style )?license
apache-2 | apache license/licence | apache( software)? (license|licence) (version |v |ver )?2( 0)?
apache-2 | apache 2 | (licensed under|under the|under|license|licence) apache( version| v)? 2( 0)?
apache-2 | apache v2 | apache( software)?( (license|licence))? v2( 0)?
apache-2 | asl 2 | asl( v)? 2 0
apache-2 | apache2 | apache2( 0)?
apache-1.1 | apache license 1 | apache( software)? license (version |v )?1 1
apache-1 | apache license 1 | apache( software)? license (version |v )?1 0
apache | apache license/licence | apache( software)?( foundation)? (license|licence)
gpl-1 | gpl 1 | (gnu )?gpl (version |v )?1( 0)?( only| or later)?
gpl-2 | gpl 2 | (gnu )?gpl (version |v )?2( 0)?( only| or later)?
gpl-3 | gpl 3 | (gnu )?gpl (version |v )?3( 0)?( only| or later)?
gpl-1 | gplv1 | (gnu )?gplv1( 0)?
gpl-2 | gplv2/gpl2 | (gnu )?gplv?2( 0)?( only| or later)?
gpl-3 | gplv3/gpl3 | (gnu )?gplv?3( 0)?( only| or later)?
gpl-1 | gnu general public 1 | gnu general public (license|licence) (version |v )?1( 0)?
gpl-2 | gnu general public 2 | gnu general public (license|licence) (version |v )?2( 0)?( only| or later)?
gpl-3 | gnu general public 3 | gnu general public (license|licence) (version |v )?3( 0)?( only| or( at your option)?( any)? later( version)?)?
gpl-2 | gnu general public v2 | gnu general public (license|licence) v2( 0)?( only| or later)?
gpl-3 | gnu general public v3 | gnu general public (license|licence) v3( 0)?( only| or later)?
gpl-2 | general public second | second version of the( gnu)? general public (license|licence)
gpl | gnu general public | gnu general public (license|licence)
gpl | gpl license/licence/licensed | (gnu )?gpl (license|licence|licensed)
gpl-2-classpath | gpl classpath exception | (gnu )?(gpl|general public license)( version| v)? ?2( 0)? with( the)? classpath exception
gpl-2-classpath | classpath exception | classpath exception
lgpl-2 | lgpl 2 | (gnu )?lgpl (version |v )?2( 0)?( only| or later)?
lgpl-2.1 | lgpl 2 1 | (gnu )?lgpl (version |v )?2 1( only| or later)?
lgpl-3 | lgpl 3 | (gnu )?lgpl (version |v )?3( 0)?( only| or later)?
lgpl-2.1 | lgplv2 1 | (gnu )?lgplv2 1( only| or later)?
lgpl-2 | lgplv2 | (gnu )?lgplv2( 0)?
lgpl-3 | lgplv3 | (gnu )?lgplv3( 0)?
lgpl-2 | library general public 2 | (gnu )?library general public (license|licence) (version |v )?2( 0)?
lgpl-2.1 | lesser general public 2 1 | (gnu )?lesser general public (license|licence) (version |v )?2 1( only| or later)?
lgpl-3 | lesser general public 3 | (gnu )?lesser general public (license|licence) (version |v )?3( 0)?( only| or later)?
lgpl-3 | lesser general public v3 | (gnu )?lesser general public (license|licence) v3( 0)?
lgpl | lesser/library general public | (gnu )?(lesser|library) general public (license|licence)
lgpl | lgpl license/licence/licensed | (gnu )?lgpl (license|licence|licensed)
agpl-1 | affero general public 1 | affero general public (license|licence) (version |v )?1( 0)?
agpl-3 | affero general public 3 | (gnu )?affero general public (license|licence) (version |v )?3( 0)?( only| or later)?
agpl-3 | affero general public v3 | (gnu )?affero general public (license|licence) v3( 0)?
agpl-3 | agpl 3 | (gnu )?agpl (version |v )?3( 0)?( only| or later)?
agpl-3 | agplv3/agpl3 | (gnu )?agplv?3( 0)?
agpl | affero general public | (gnu )?affero general public (license|licence)
agpl | agpl license/licence/licensed | (gnu )?agpl (license|licence|licensed)
gfdl-1.1 | free documentation 1 | (gnu )?free documentation (license|licence) (version |v )?1 1
gfdl-1.2 | free documentation 1 2 | (gnu )?free documentation (license|licence) (version |v )?1 2
gfdl-1.3 | free documentation 1 3 | (gnu )?free documentation (license|licence) (version |v )?1 3
gfdl | free documentation | (gnu )?free documentation (license|licence)
gfdl | gfdl | gfdl
gpl-all-permissive | all permissive gnu | gnu all permissive license
mpl-1 | mozilla public 1 | mozilla public (license|licence) (version |v )?1 0
mpl-1.1 | mozilla public 1 | mozilla public (license|licence) (version |v )?1 1
mpl-2 | mozilla public 2 | mozilla public (license|licence) (version |v )?2( 0)?
mpl-2 | mozilla public v2 | mozilla public (license|licence) v2( 0)?
mpl-2 | mpl 2 | mpl (version |v )?2( 0)?
mpl-1.1 | mpl 1 | mpl (version |v )?1 1
mpl | mozilla public | mozilla public (license|licence)
npl | netscape public | netscape public (license|licence)
cddl-1 | cddl 1 | cddl (version |v )?1 0
cddl-1.1 | cddl 1 | cddl (version |v )?1 1
cddl | common development distribution | common development and distribution (license|licence)
cpl-1 | common public 1 | common public (license|licence) (version |v )?1 0
cpl | common public | common public (license|licence)
ipl-1 | ibm public | ibm public (license|licence)( version 1 0)?
epl-1 | eclipse public 1 | eclipse public (license|licence) (version |v )?1( 0)?
epl-1 | eclipse public v1 | eclipse public (license|licence) v1 0
epl-2 | eclipse public 2 | eclipse public (license|licence) (version |v )?2( 0)?
epl-2 | eclipse public v2/v20 | eclipse public (license|licence) v20?( 0)?
epl | eclipse public | eclipse public (license|licence)
edl-1 | eclipse distribution | eclipse distribution (license|licence)( v(ersion)? ?1 0)?
eupl-1.1 | eupl/european 1 | (eupl|european union public (license|licence)) (version |v )?1 1
eupl-1.2 | eupl/european 1 2 | (eupl|european union public (license|licence)) (version |v )?1 2
eupl | european union public | european union public (license|licence)
eupl | eupl | eupl
ms-pl | microsoft public | microsoft public (license|licence)( ms pl)?
ms-rl | microsoft reciprocal | microsoft reciprocal (license|licence)( ms rl)?
ms-pl | ms pl | ms pl
artistic-1 | artistic 1 | artistic (license|licence) (version |v )?1( 0)?
artistic-2 | artistic 2 | artistic (license|licence) (version |v )?2( 0)?
artistic | artistic license/licence | artistic (license|licence)
perl | perl terms | (same terms as|under the terms of) perl( itself| 5)?
zlib | zlib license/licence | zlib( libpng)? (license|licence)
libpng | libpng license/licence | libpng (license|licence)( version 2)?
boost-1 | boost license/licence | boost( software)? (license|licence)( (version |v )?1( 0)?)?
boost-1 | bsl 1 0 boost | bsl 1 0
unlicense | unlicense | (the )?unlicense
cc0-1 | cc0 | cc0( 1 0)?( universal)?
cc0-1 | creative zero | creative commons zero( v?1 0)?( universal)?
public-domain | public domain | (in|into|to) the public domain
public-domain | public domain dedication/dedicated | public domain (dedication|dedicated)
pddl-1 | open data public domain | open data commons public domain dedication (and|&) license
odbl-1 | odbl/open database | (odbl|open database (license|licence))( v?1 0)?
odc-by-1 | odc/data attribution | (odc by|open data commons attribution license)( v?1 0)?
wtfpl | wtfpl | wtfpl
beerware | beerware/beer license/licence | beer ?ware (license|licence)
python-2 | python software foundation | python software foundation (license|licence)( version 2)?
python-2 | psf license/licence | psf (license|licence)
php-3 | php license/licence 3 | php (license|licence) (version |v )?3 0?[01]
php | php license/licence | php (license|licence)
ruby | ruby license/licence | ruby (license|licence)
postgresql | postgresql license/licence | postgresql (license|licence)
openssl | openssl license/licence | openssl (license|licence)
vim | vim license/licence | vim (license|licence)
curl | curl license/licence | curl (license|licence)
ncsa | ncsa license/licence | ncsa( open source)? (license|licence)
w3c | w3c license/licence | w3c( software)?( (and|&) document)?( notice and)? (license|licence)
unicode | unicode license | unicode( inc)?( data files and software)? (license|licence)( agreement)?
icu | icu license/licence | icu (license|licence)
ofl-1.1 | ofl/font 1 | (ofl|open font (license|licence)) (version |v )?1 1
ofl | open font | (sil )?open font (license|licence)
json | json license/licence | json (license|licence)
sspl-1 | server side public | server side public (license|licence)( v(ersion)? ?1)?
sspl-1 | sspl | sspl( v?1)?
bsl-1.1 | business source | business source (license|licence)( (version |v )?1 1)?
busl | busl | busl 1 1
elastic-2 | elastic 2 license/licence | elastic (license|licence) (version |v )?2( 0)?
elastic | elastic license/licence | elastic (license|licence)
commons-clause | commons clause | commons clause( license condition)?( v?1 0)?
polyform-nc | polyform noncommercial | polyform noncommercial (license|licence)( 1 0 0)?
polyform-sb | polyform small | polyform small business (license|licence)( 1 0 0)?
afl-3 | academic free | academic free (license|licence)( (version |v )?3 0)?
osl-3 | open software 3 license/licence | open software (license|licence) (version |v )?3 0
osl | open software license/licence | open software (license|licence)
ecl-2 | educational community | educational community (license|licence)( (version |v )?2 0)?
qpl-1 | q public | q public (license|licence)
sleepycat | sleepycat | sleepycat (license|licence)
cecill-2.1 | cecill 2 | cecill (version |v )?2 1
cecill-c | cecill c | cecill c
cecill-b | cecill b | cecill b
cecill | cecill | cecill( (license|licence))?
upl-1 | universal permissive | universal permissive (license|licence)( v?1 0)?
mulan-2 | mulan | mulan (psl|permissive software license)( v?2)?
blueoak-1 | blue oak | blue oak model (license|licence)( 1 0 0)?
apsl-2 | apple public source | apple public source (license|licence)( (version |v )?2 0)?
zpl-2 | zope public | zope public (license|licence)( (version |v )?2 [01])?
tcl | tcl license/licence | tcl( tk)? (license|licence)
imagemagick | imagemagick license/licence | imagemagick (license|licence)
lppl-1.3 | latex project public | latex project public (license|licence)( (version |v )?1 3[abc]?)?
gsl | gnu scientific | gnu scientific library license
openrail-m | openrail | (creativeml )?(bigscience )?open ?rail( m)?( (license|licence))?
llama-2 | llama 2 community | llama 2 community license( agreement)?
llama-3 | llama 3 community | (meta )?llama 3( [123])? community license( agreement)?
gemma | gemma terms | gemma terms of use
cc-by | cc by | cc by( [1-4] [05])?( international| unported)?
cc-by-sa | cc by sa | cc by sa( [1-4] [05])?( international| unported)?
cc-by-nc | cc nc by | cc by nc( [1-4] [05])?( international| unported)?
cc-by-nd | cc by nd | cc by nd( [1-4] [05])?( international| unported)?
cc-by-nc-sa | cc nc sa | cc by nc sa( [1-4] [05])?( international| unported)?
cc-by-nc-nd | cc nc nd | cc by nc nd( [1-4] [05])?( international| unported)?
cc-by | creative attribution | creative commons attribution( [1-4] [05])?( international| unported| generic)?( (license|licence))?
cc-by-sa | creative attribution sharealike/alike | creative commons attribution share ?alike( [1-4] [05])?( international| unported| generic)?( (license|licence))?
cc-by-nc | creative attribution noncommercial/commercial | creative commons attribution non ?commercial( [1-4] [05])?( international| unported| generic)?( (license|licence))?
cc-by-nd | creative attribution noderivatives/noderivs/derivatives | creative commons attribution no ?deriv(ative)?s( works)?( [1-4] [05])?( international| unported| generic)?
cc-by-nc-sa | creative noncommercial/commercial sharealike/alike | creative commons attribution non ?commercial share ?alike( [1-4] [05])?( international| unported| generic)?
cc-by-nc-nd | creative noncommercial/commercial noderivatives/noderivs/derivatives | creative commons attribution non ?commercial no ?deriv(ative)?s( works)?( [1-4] [05])?( international| unported| generic)?
"""

LINKS = r"""
mit | opensource licenses/license mit | opensource org licen[sc]es?( licen[sc]es)? mit( license)?( php| html)?
bsd-3 | opensource bsd | opensource org licen[sc]es? bsd( 3 clause| license)( php| html)?
bsd-2 | opensource bsd 2 | opensource org licen[sc]es? bsd 2 clause
apache-2 | apache licenses 2 | apache org licenses license 2 0( txt| html)?
gpl-2 | gnu licenses gpl/old 2 | gnu org licenses (old licenses )?gpl 2 0( en)?( txt| html)?
gpl-3 | gnu licenses gpl 3 | gnu org licenses gpl 3 0( en)?( txt| html)?
lgpl-2.1 | gnu licenses lgpl 2 1 | gnu org licenses (old licenses )?lgpl 2 1( en)?( txt| html)?
lgpl-3 | gnu licenses lgpl 3 | gnu org licenses lgpl 3 0( en)?( txt| html)?
agpl-3 | gnu licenses agpl | gnu org licenses agpl 3 0( en)?( txt| html)?
gpl | gnu licenses gpl | gnu org licenses gpl( txt| html)?
gfdl | gnu licenses fdl | gnu org licenses fdl( 1 [123])?( txt| html)?
mpl-2 | mozilla mpl 2 | mozilla org mpl 2 0
mpl-1.1 | mozilla mpl 1 | mozilla org mpl( mpl)? 1 1( html| txt)?
epl-1 | eclipse legal v10 | eclipse org legal epl v10( html)?
epl-2 | eclipse legal 2/v20 | eclipse org legal epl (v20|2 0)( html)?
boost-1 | boost license | boost org license 1 0( txt)?
unlicense | unlicense org | unlicense org
cc0-1 | creativecommons zero | creativecommons org publicdomain zero 1 0
public-domain | creativecommons mark | creativecommons org publicdomain mark 1 0
cc-by | creativecommons licenses by | creativecommons org licenses by [1-4] [05]
cc-by-sa | creativecommons licenses sa | creativecommons org licenses by sa [1-4] [05]
cc-by-nc | creativecommons licenses nc | creativecommons org licenses by nc [1-4] [05]
cc-by-nd | creativecommons licenses nd | creativecommons org licenses by nd [1-4] [05]
cc-by-nc-sa | creativecommons licenses nc sa | creativecommons org licenses by nc sa [1-4] [05]
cc-by-nc-nd | creativecommons licenses nc nd | creativecommons org licenses by nc nd [1-4] [05]
odbl-1 | opendatacommons odbl | opendatacommons org licenses odbl
pddl-1 | opendatacommons pddl | opendatacommons org licenses pddl
ofl-1.1 | scripts sil ofl | scripts sil org ofl
artistic-2 | opensource artistic | opensource org licen[sc]es? artistic( license)? 2 0
isc | opensource isc | opensource org licen[sc]es? isc( license)?
"""

HINTS = r"""
proprietary | rights reserved | all rights reserved
copyright | copyright | copyright( c)? (19|20)[0-9][0-9]( (19|20)[0-9][0-9])?
proprietary | proprietary license/licence | proprietary (license|licence)
commercial | commercial license/licence | commercial (license|licence)
open-source | open source license/licence | open source (license|licence)
copyleft | copyleft | copyleft( (license|licence))?
permissive | permissive license/licence | permissive( open source| software)? (license|licence)
freeware | freeware | freeware( (license|licence))?
shareware | shareware | shareware( (license|licence))?
eula | end user license/licence agreement | end user (license|licence) agreement
eula | eula | eula
non-commercial | non commercial use only | (for )?non commercial use only
non-commercial | noncommercial use only | (for )?noncommercial use only
research-only | research purposes only | (for )?(academic |non commercial )?research purposes only
creative-commons | creative commons | creative commons( (license|licence))?
gpl | gpl | (gnu )?gpl
lgpl | lgpl | (gnu )?lgpl
agpl | agpl | (gnu )?agpl
"""

SHIELDS = r"""
- | license/licence plate/plates | (license|licence) plates?
- | driver/drivers/driving license/licence | (drivers?( s)?|driving) (license|licence)
- | license/licence fee/fees | (license|licence) fees?
- | license/licence key/server/manager | (license|licence) (key|server|manager)s?
- | apache helicopter/tribe/helicopters/tribes | apache (helicopter|tribe)s?
- | public domain/sphere name/names | public domain names?
- | not mit license/licence | not( \S+){0,2} under the mit (license|licence) but
"""

#: Identifiers of the public license list, by label. Tags are derived from them: see ``_tags``.
IDENTIFIERS = """
mit: MIT; mit-0: MIT-0; isc: ISC; 0bsd: 0BSD; bsd-2: BSD-2-Clause; bsd-3: BSD-3-Clause; bsd-4: BSD-4-Clause;
apache-1: Apache-1.0; apache-1.1: Apache-1.1; apache-2: Apache-2.0; gpl-1: GPL-1.0; gpl-2: GPL-2.0; gpl-3: GPL-3.0;
lgpl-2: LGPL-2.0; lgpl-2.1: LGPL-2.1; lgpl-3: LGPL-3.0; agpl-1: AGPL-1.0; agpl-3: AGPL-3.0; gfdl-1.1: GFDL-1.1;
gfdl-1.2: GFDL-1.2; gfdl-1.3: GFDL-1.3; mpl-1: MPL-1.0; mpl-1.1: MPL-1.1; mpl-2: MPL-2.0; npl-1.1: NPL-1.1;
cddl-1: CDDL-1.0; cddl-1.1: CDDL-1.1; cpl-1: CPL-1.0; ipl-1: IPL-1.0; epl-1: EPL-1.0; epl-2: EPL-2.0;
eupl-1.1: EUPL-1.1; eupl-1.2: EUPL-1.2; ms-pl: MS-PL; ms-rl: MS-RL; artistic-1: Artistic-1.0; artistic-2: Artistic-2.0;
zlib: Zlib; libpng: Libpng; boost-1: BSL-1.0; unlicense: Unlicense; cc0-1: CC0-1.0; pddl-1: PDDL-1.0; odbl-1: ODbL-1.0;
odc-by-1: ODC-By-1.0; wtfpl: WTFPL; beerware: Beerware; python-2: PSF-2.0; php-3: PHP-3.01; ruby: Ruby;
postgresql: PostgreSQL; openssl: OpenSSL; vim: Vim; curl: curl; ncsa: NCSA; w3c: W3C; icu: ICU; ofl-1.1: OFL-1.1;
json: JSON; sspl-1: SSPL-1.0; bsl-1.1: BUSL-1.1; elastic-2: Elastic-2.0; afl-3: AFL-3.0; osl-3: OSL-3.0; ecl-2: ECL-2.0;
qpl-1: QPL-1.0; sleepycat: Sleepycat; cecill-2.1: CECILL-2.1; cecill-b: CECILL-B; cecill-c: CECILL-C; upl-1: UPL-1.0;
mulan-2: MulanPSL-2.0; blueoak-1: BlueOak-1.0.0; apsl-2: APSL-2.0; zpl-2: ZPL-2.1; tcl: TCL; lppl-1.3: LPPL-1.3c;
cc-by: CC-BY-4.0; cc-by-sa: CC-BY-SA-4.0; cc-by-nc: CC-BY-NC-4.0; cc-by-nd: CC-BY-ND-4.0;
cc-by-nc-sa: CC-BY-NC-SA-4.0; cc-by-nc-nd: CC-BY-NC-ND-4.0; hpnd: HPND; x11: X11; unicode: Unicode-DFS-2016
"""


def _read(table: str, level: int) -> list[dict]:
    rules = []
    for line in table.strip().splitlines():
        label, needs, regex = line.split(" | ", 2)
        rules.append({"label": label.replace("-", "") and label, "level": level, "needs": [n.split("/") for n in needs.split()], "regex": regex})
    return rules


def _tags(identifiers: str) -> list[dict]:
    """A rule for each identifier behind the tag that source files carry it with."""
    rules = []
    for entry in identifiers.replace("\n", " ").split(";"):
        label, identifier = entry.split(":")
        words = " ".join(re.findall("[a-z0-9]+", identifier.lower()))
        regex = f"spdx (license|licence) identifier {words}( only| or later)?"
        needs = [["spdx"], ["identifier"], *([w] for w in words.split())]
        rules.append({"label": label.strip(), "level": TAG, "needs": needs, "regex": regex})
    return rules


def all_rules() -> list[dict]:
    """Every rule with its number: of two that find the same words at one level, the lower one wins."""
    rules = [*_read(PHRASES, BASE), *_read(SHIELDS, NOTICE), *_read(NOTICES, NOTICE), *_tags(IDENTIFIERS)]
    rules += [*_read(LINKS, TAG), *_read(NAMES, NAME), *_read(HINTS, HINT)]
    return [{"rule": i, **r} for i, r in enumerate(rules)]
