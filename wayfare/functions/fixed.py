"""Codes, word lists and lookup tables the results depend on."""

from __future__ import annotations

# --- fixed values: rating codes of one to five stars -------------------------
RATING_CODES = ["10", "20", "30", "40", "50"]

# --- fixed value: label reported for a star class that has no reviews --------
MISSING_LABEL = 20.0

# --- fixed values: training parameters ---------------------------------------
HASH_BUCKETS = 4096
MIN_DOC_FREQ = 5
MAX_ITER = 100
SPLIT_WEIGHTS = [0.9, 0.1]
SPLIT_SEED = 2000

# --- fixed values: line format and site addresses ----------------------------
DELIMITER = "||"
REVIEW_FIELDS = ["username", "rating", "review", "date"]
ATTRACTION_URL = "https://www.tripadvisor.com/Attraction_Review"
HOME_URL = "https://www.tripadvisor.com/Home"

# --- fixed values: Spark ML's English stop words ------------------------------
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him
his himself she her hers herself it its itself they them their theirs
themselves what which who whom this that these those am is are was were be been
being have has had having do does did doing a an the and but if or because as
until while of at by for with about against between into through during before
after above below to from up down in out on off over under again further then
once here there when where why how all any both each few more most other some
such no nor not only own same so than too very s t can will just don should now
i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm
you're he's she's it's we're they're i've we've you've they've isn't aren't
wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't
shouldn't mustn't can't couldn't cannot could here's how's let's ought that's
there's what's when's where's who's why's would
""".split()

# --- fixed values: cities (code, name, geo id, page suffix, blurb) ------------
CITIES = [
    (
        "london",
        "London",
        "g186338",
        "-London_England.html",
        "The crown jewels, Buckingham Palace, Camden Market…in London, history collides with art, fashion, food, and good British ale. A perfect day is different for everyone: culture aficionados shouldn't miss the Tate Modern and the Royal Opera House. If you love fashion, Oxford Street has shopping galore. For foodies, cream tea at Harrod’s or crispy fish from a proper chippy offers classic London flavor. Music and book buffs will love seeing Abbey Road and the Sherlock Holmes Museum (at 221B Baker Street, of course).",
    ),
    (
        "nyc",
        "New York City",
        "g60763",
        "-New_York_City_New_York.html",
        "Conquering New York in one visit is impossible. Instead, hit the must-sees – the Empire State Building, the Statue of Liberty, Central Park, the Metropolitan Museum of Art – and then explore off the beaten path with visits to The Cloisters or one of the city’s libraries. Indulge in the bohemian shops of the West Village or the fine dining of the Upper West Side. The bustling marketplace inside of Grand Central Station gives you a literal taste of the best the city has to offer.",
    ),
    (
        "paris",
        "Paris",
        "g187147",
        "-Paris_Ile_de_France.html",
        "Lingering over pain au chocolat in a sidewalk café, relaxing after a day of strolling along the Seine and marveling at icons like the Eiffel Tower and the Arc de Triomphe… the perfect Paris experience combines leisure and liveliness with enough time to savor both an exquisite meal and exhibits at the Louvre. Awaken your spirit at Notre Dame, bargain hunt at the Marché aux Puces de Montreuil or for goodies at the Marché Biologique Raspail, then cap it all off with a risqué show at the Moulin Rouge.",
    ),
]

# --- fixed values: attraction keys by city and tier ---------------------------
CATALOGUE = {
    ("london", "1-10"): """
        d188862-Reviews-National_Gallery
        d187552-Reviews-Tower_Bridge
        d189032-Reviews-Westminster_Abbey
        d187556-Reviews-V_A_Victoria_and_Albert_Museum
        d260500-Reviews-Borough_Market
        d187676-Reviews-Natural_History_Museum
        d189030-Reviews-Hyde_Park
    """.split(),
    ("london", "11-30"): """
        d188159-Reviews-St_Paul_s_Cathedral
        d548817-Reviews-Chelsea_FC_Stadium_Tour_Museum
        d211708-Reviews-Houses_of_Parliament
        d188126-Reviews-St_James_s_Park
        d189047-Reviews-Covent_Garden
        d187577-Reviews-Camden_Market
        d187726-Reviews-Shakespeare_s_Globe_Theatre
        d7398968-Reviews-Sky_Garden
        d3539289-Reviews-The_View_from_The_Shard
        d187601-Reviews-Greenwich
        d3263267-Reviews-Up_at_The_O2
        d187549-Reviews-Buckingham_Palace
        d187675-Reviews-Regent_s_Park
        d188893-Reviews-Kensington_Gardens
        d187674-Reviews-Imperial_War_Museums
        d1775127-Reviews-Emirates_Stadium_Tour_and_Museum
        d187558-Reviews-Wallace_Collection
        d187560-Reviews-Museum_of_London
        d187551-Reviews-HMS_Belfast
        d194290-Reviews-Highgate_Cemetery
    """.split(),
    ("nyc", "1-10"): """
        d105127-Reviews-Central_Park
        d1687489-Reviews-The_National_9_11_Memorial_Museum
        d105125-Reviews-The_Metropolitan_Museum_of_Art
        d104365-Reviews-Empire_State_Building
        d587661-Reviews-Top_of_the_Rock
        d103887-Reviews-Statue_of_Liberty
        d102741-Reviews-Brooklyn_Bridge
        d116236-Reviews-New_York_Public_Library
        d8072300-Reviews-One_World_Observatory
        _d267031-Reviews-Manhattan_Skyline
    """.split(),
    ("nyc", "11-30"): """
        d143358-Reviews-Intrepid_Sea_Air_Space_Museum
        d103371-Reviews-Grand_Central_Terminal
        d136053-Reviews-St_Patrick_s_Cathedral
        d105123-Reviews-Rockefeller_Center
        d267031-Reviews-Manhattan_Skyline
        d110164-Reviews-Radio_City_Music_Hall
        d143361-Reviews-Broadway
        d106609-Reviews-The_Met_Cloisters
        d136347-Reviews-Bryant_Park
        d110145-Reviews-Times_Square
        d104370-Reviews-Ellis_Island
        d275371-Reviews-Madison_Square_Garden
        d143367-Reviews-Greenwich_Village
        d143363-Reviews-Staten_Island_Ferry
        d10340693-Reviews-The_Oculus
        d288031-Reviews-Chelsea_Market
        d210108-Reviews-American_Museum_of_Natural_History
        d12291624-Reviews-Gulliver_s_Gate
        d105126-Reviews-The_Museum_of_Modern_Art
        d10749293-Reviews-Christmas_Spectacular_Starring_the_Radio_City_Rockettes
    """.split(),
    ("paris", "1-10"): """
        d188757-Reviews-Louvre_Museum
        d190202-Reviews-Sainte_Chapelle
        d188151-Reviews-Eiffel_Tower
        d190204-Reviews-Palais_Garnier_Opera_National_de_Paris
        d189683-Reviews-Seine_River
        d188709-Reviews-Arc_de_Triomphe
        d265635-Reviews-Musee_de_l_Orangerie
        d189687-Reviews-Luxembourg_Gardens
    """.split(),
    ("paris", "11-30"): """
        d189687-Reviews-Luxembourg_Gardens
        d190685-Reviews-Basilique_du_Sacre_Coeur_de_Montmartre
        d292257-Reviews-Le_Marais
        d188149-Reviews-Musee_Rodin
        d246750-Reviews-Trocadero
        d189280-Reviews-Pantheon
        d191240-Reviews-Saint_Germain_des_Pres_Quarter
        d188485-Reviews-Musee_Marmottan_Monet
        d189245-Reviews-Musee_de_l_Armee_des_Invalides
        d194171-Reviews-Jardin_des_Tuileries
        d189685-Reviews-Latin_Quarter
        d314450-Reviews-Observatoire_Panoramique_de_la_Tour_Montparnasse
        d189193-Reviews-Galeries_Lafayette_Paris_Haussmann
        d265614-Reviews-Pont_Alexandre_III
        d189249-Reviews-Parc_des_Buttes_Chaumont
        d188761-Reviews-Musee_Jacquemart_Andre
        d13986330-Reviews-Atelier_des_Lumieres
        d188698-Reviews-Cemiterio_de_Pere_Lachaise
        d188467-Reviews-Place_des_Vosges
        d2397509-Reviews-Towers_of_Notre_Dame_Cathedral
    """.split(),
}
