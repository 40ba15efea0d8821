"""Letters that look alike across scripts."""

# fixed values: letters of other scripts and the Latin letters they look like
CYRILLIC = dict(zip("АВЕЅІЈКМНОРСТУХаеѕіјорсухԁһԛԝ", "ABESIJKMHOPCTYXaesijopcyxdhqw"))
GREEK = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονιαυρκ", "ABEZHIKMNOPTYXoviaupk"))
ARMENIAN = dict(zip("օսհոցՏՍՕԼ", "ouhngSUOL"))
CHEROKEE = dict(zip("ᎪᏴᏟᎠᎬᏀᎻᏆᎫᏦᏞᎷᏢᎡᏚᎢᏙᎳᏃ", "ABCDEGHIJKLMPRSTVWZ"))
LOOKS = CYRILLIC | GREEK | ARMENIAN | CHEROKEE
