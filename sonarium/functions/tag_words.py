"""Words by which a tag is told from a genre."""

# Places, instruments, words of releases and descriptions, moods, and codes of states.
PLACES = """
usa|u.s.a.|us|united states|uk|u.k.|united kingdom|england|scotland|wales|ireland|canada|australia|new zealand|germany|france|italy|spain|
portugal|netherlands|belgium|sweden|norway|denmark|finland|iceland|poland|russia|ukraine|japan|china|korea|south korea|brazil|argentina|
chile|mexico|colombia|india|indonesia|greece|turkey|austria|switzerland|czech republic|hungary|romania|south africa|
london|manchester|bristol|glasgow|berlin|hamburg|cologne|paris|lyon|amsterdam|rotterdam|stockholm|oslo|copenhagen|helsinki|reykjavik|dublin|
lisbon|madrid|barcelona|rome|milan|vienna|zurich|tokyo|osaka|kyoto|seoul|beijing|shanghai|sydney|melbourne|auckland|toronto|montreal|
vancouver|new york|new york city|nyc|brooklyn|los angeles|la|san francisco|bay area|oakland|seattle|portland|chicago|detroit|atlanta|austin|
nashville|new orleans|boston|philadelphia|washington dc|denver|minneapolis|cdmx|mexico city|sao paulo|rio de janeiro|buenos aires|bogota|
toulouse|lille|bordeaux|nantes|marseille|strasbourg|leeds|sheffield|nottingham|liverpool|cardiff|belfast|gothenburg|malmo|antwerp|ghent|
turin|naples|valencia|seville|porto|krakow|warsaw|prague|budapest
""".replace("\n", "").split("|")
INSTRUMENTS = """
piano|guitar|acoustic guitar|electric guitar|drums|saxophone|sax|violin|cello|viola|flute|trumpet|trombone|clarinet|accordion|banjo|harp|
ukulele|mandolin|harmonica|organ|double bass|percussion
""".replace("\n", "").split("|")
META = """
female vocals|male vocals|female vocalist|male vocalist|female fronted|vocals|vocal|instrumental|seen live|favorites|favourites|diy|vinyl|cassette|
cassette tape|demo|compilation|live|ep|lp|album|single|mixtape|split|self released|self-released|free download|free|all|various|various artists|
soundtrack|score|atmospheric|chill|chilled|dark|dreamy|melancholic|melancholy|energetic|cinematic|ethereal|moody|uplifting|relaxing|sad|
happy|epic|experimental music|good|best|new|fun|cool
""".replace("\n", "").split("|")
MOODS = """
depressing|erotic|exotic|easy|sexy|sensual|romantic|nostalgic|soothing|aggressive|angry|calm|gloomy|haunting|dramatic|intense|
playful|quirky|groovy|mellow|smooth|spooky|creepy|warm|cold|feel good|feelgood|bittersweet|hopeful|anthemic|danceable
""".replace("\n", "").split("|")
STATES = "al ak az ar ca co ct de fl ga hi id il in ia ks ky la me md ma mi mn ms mo mt ne nv nh nj nm ny nc nd oh ok or pa ri sc sd tn tx ut vt va wa wv wi wy".split()
# Patterns of eras, labels and numbers.
ERA = r"^((19|20)?[0-9]0['’]?s|twenties|thirties|forties|fifties|sixties|seventies|eighties|nineties|noughties|aughts)(\s+.+)?$"
LABEL = r"\b(records|recordings|tapes|tape|label|productions|recs)$"
NUMERIC = r"^[0-9\s.,'-]+$"
