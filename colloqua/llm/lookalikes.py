"""Letters that look like ASCII ones."""

#: Letters whose usual glyph is that of the Latin letter after them, by script.
PAIRS = {
    "Cyrillic": "аa еe оo рp сc уy хx іi јj ѕs ԁd һh ԛq ԝw ӏl АA ВB ЕE КK МM НH ОO РP СC ТT УY ХX ІI ЈJ ЅS ԌG ԚQ ԜW ҮY",
    "Greek": "οo νv ϲc ϳj ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX ϹC ͿJ",
    "Armenian": "օo ոn սu հh ցg",
    "Cherokee": "ᎪA ᏴB ᏟC ᎠD ᎬE ᏀG ᎻH ᎫJ ᏦK ᏞL ᎷM ᏢP ᏒR ᏚS ᎢT ᏙV ᎳW ᏃZ",
    "Coptic": "ⲞO ⲟo ⲢP ⲣp ⲤC ⲥc ⲒI ⲔK ⲘM ⲚN ⲦT ⲨY ⲬX ⲎH",
    "Lisu": "ꓐB ꓑP ꓓD ꓔT ꓖG ꓗK ꓙJ ꓚC ꓜZ ꓝF ꓟM ꓠN ꓡL ꓢS ꓣR ꓦV ꓧH ꓪW ꓫX ꓬY ꓮA ꓰE ꓲI ꓳO ꓴU",
    "Latin": "ɡg",
}
LOOK_ALIKES = {pair[0]: pair[1] for listed in PAIRS.values() for pair in listed.split()}
