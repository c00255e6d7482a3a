"""Terms of the sources in their own language. All are fixed values that results depend on."""

# Period terms and the periods each stands for. A longer term is looked for before a shorter one.
PERIOD_TERMS = {
    "פרהיסטור": ["paleolithic"],
    "פליאולית": ["paleolithic"],
    "אפיפליאולית": ["paleolithic"],
    "נאולית": ["neolithic"],
    "ניאולית": ["neolithic"],
    "כלקולית": ["chalcolithic"],
    "ברונזה ביניימית": ["bronze_early"],
    "ברונזה קדומה": ["bronze_early"],
    "ברונזה תיכונה": ["bronze_middle"],
    "ברונזה מאוחרת": ["bronze_late"],
    "ברונזה": ["bronze_early", "bronze_middle", "bronze_late"],
    'ב"ק': ["bronze_early"],
    'ב"ת': ["bronze_middle"],
    'ב"מ': ["bronze_late"],
    "ברזל": ["iron"],
    "ישראלית": ["iron"],
    "פרסית": ["persian"],
    "הלניסט": ["hellenistic"],
    "רומית": ["roman"],
    "רומאית": ["roman"],
    "ביזנט": ["byzantine"],
    "אסלאמית קדומה": ["early_islamic"],
    "אסלמית קדומה": ["early_islamic"],
    "אסלאמית מאוחרת": ["crusader", "mamluk"],
    "אסלמית מאוחרת": ["crusader", "mamluk"],
    "אסלאמית": ["early_islamic"],
    "צלבנ": ["crusader"],
    "איובית": ["crusader"],
    "ממלוכ": ["mamluk"],
    "עות'מנית קדומה": ["ottoman_early"],
    "עותמנית קדומה": ["ottoman_early"],
    "עות'מנית מאוחרת": ["ottoman_late"],
    "עותמנית מאוחרת": ["ottoman_late"],
    "עות'מנ": ["ottoman_early", "ottoman_late"],
    "עותמנ": ["ottoman_early", "ottoman_late"],
    "טורקית": ["ottoman_early", "ottoman_late"],
    "מנדט": ["mandate"],
    "מנדטור": ["mandate"],
    "בריטית": ["mandate"],
    "מדינת ישראל": ["state"],
    "מודרנ": ["state"],
}

# Type terms. A longer term is looked for before a shorter one.
TYPE_TERMS = {
    "בית כנסת": "synagogue_ancient",
    "כנסי": "church_ancient",
    "מנזר": "church_ancient",
    "פסיפס": "mosaic",
    "מצודה": "fortification",
    "מבצר": "fortification",
    "ביצור": "fortification",
    "מחנה צבא": "fortification",
    "קבורה": "burial",
    "קבר": "burial",
    "נקרופול": "necropolis",
    "מערת קבורה": "burial",
    "טחנת קמח": "mill",
    "טחנת": "mill",
    "מעין": "water_installation",
    "מעיין": "water_installation",
    "בור מים": "water_installation",
    "באר": "water_heritage",
    "אמת מים": "water_installation",
    "מתקן מים": "water_installation",
    "גת": "agricultural_installation",
    "בית בד": "agricultural_installation",
    "מלאכה וחקלאות": "agricultural_installation",
    "מחצבה": "quarry",
    "אבן מיל": "road_milestone",
    "מערה": "cave",
    "ח'אן": "khan",
    "חאן": "khan",
    "יישוב/חורבה/תל": "settlement_remains",
    "חורבה": "khirbe",
    "תל": "tel",
    "ישוב": "settlement_remains",
    "מכלול": "settlement_remains",
    "טמפלר": "templer",
    "מגדל מים": "industrial_heritage",
    "בניין שימור": "settlement_heritage",
    "מבנה שימור": "settlement_heritage",
    "בית ראשונים": "founders_building",
    "תחנת רכבת": "railway",
    "רכבת": "railway",
    "קטר": "railway",
    "אנדרט": "memorial",
    "הנצחה": "memorial",
    "פסל": "memorial",
    "בית קברות": "cemetery",
    "מסגד": "place_of_worship",
    "מורשת ביטחונ": "defense_heritage",
    "חומה ומגדל": "defense_heritage",
    "מורשת התיישבות": "settlement_heritage",
    "מרכז מבקרים": "visitor_center",
    "מוזיאון": "museum",
    "מוזאון": "museum",
    "ארכיון": "archive",
    "ספרי": "library",
    "מרכז מורשת": "heritage_center",
    "קונסרבטור": "conservatory",
    "בית ספר לאומנ": "art_school",
    "אולפן הקלטות": "studio_collective",
    "סטודיו": "studio_collective",
    "נגרי": "studio_collective",
    "קרמיק": "studio_collective",
    "גלרי": "gallery",
    "גלריי": "gallery",
    "אמפי": "amphitheater",
    "היכל התרבות": "hall",
    "אולם": "hall",
    "קולנוע": "cinema",
    "מרכז תרבות": "community_culture_center",
    'מתנ"ס': "community_culture_center",
    "מרכז קהילת": "community_culture_center",
    "בית תרבות": "community_culture_center",
    "פסטיבל": "festival_venue",
}

# The conservation survey's columns and the status values that their entries stand for.
EXCAVATION_STATE = {"חפור במלואו": "excavated", "חפור בחלקו": "excavated", "בחפירה": "excavated", "לא חפור": "not_excavated", "נסקר": "surveyed_only"}
TOURISM_DEVELOPMENT = {"מוסדר ופתוח לקהל": "developed", "פתוח לקהל ללא שירותים": "partial", "סגור למבקרים": "undeveloped"}
TOURISM_ACCESS = {"מוסדר ופתוח לקהל": "open_free", "פתוח לקהל ללא שירותים": "open_free", "סגור למבקרים": "not_accessible"}
ENGINEERING_STATE = {"יציב": "good", "מעורער": "fair", "מסוכן": "poor", "הרוס": "destroyed"}
RISK_LEVEL = {"גבוהה": "endangered"}
CONSERVATION_STATE = {
    "בוצע שימור מלא": "restored", "בוצע שימור חלקי": "restored", "שימור מלווה חפירה": "restored", "כיסוי קבוע מלא": "plan_approved", "פסיפסים הוצאו": "plan_approved", "לא בוצע שימור": "surveyed",
}
INVENTORY_STATE = {"פעיל": ("activity", "active"), "משומר": ("reg_conservation", "restored"), "מוכר": ("reg_conservation", "listed")}

# Map tags, subtypes and classes that stand for a type, and classes that don't.
MAP_TAG_TYPES = {
    "historic=archaeological_site": "settlement_remains", "historic=ruins": "khirbe", "historic=tomb": "burial", "historic=monument": "memorial", "historic=memorial": "memorial",
    "historic=castle": "fortification", "historic=fort": "fortification", "historic=city_gate": "fortification", "historic=aqueduct": "water_installation", "historic=milestone": "road_milestone",
    "historic=battlefield": "defense_heritage", "historic=building": "settlement_heritage", "historic=church": "church_ancient", "historic=wayside_shrine": "place_of_worship",
    "man_made=watermill": "mill", "man_made=water_well": "water_heritage", "man_made=water_tower": "industrial_heritage", "tourism=museum": "museum", "tourism=gallery": "gallery",
    "tourism=artwork": "memorial", "amenity=library": "library", "amenity=arts_centre": "gallery", "amenity=theatre": "hall", "amenity=community_centre": "community_culture_center",
    "amenity=place_of_worship": "place_of_worship", "amenity=cinema": "cinema", "historic=locomotive": "railway", "railway=station": "railway",
}
SUBTYPES = {
    "tell": "tel", "settlement": "settlement_remains", "necropolis": "necropolis", "tumulus": "burial", "megalith": "prehistoric", "fortification": "fortification", "villa": "settlement_remains",
    "roman_villa": "settlement_remains", "city": "settlement_remains", "cave": "cave", "petroglyph": "prehistoric",
}
CLASS_TYPES = {
    "Q839954": "settlement_remains", "Q207694": "museum", "Q33506": "museum", "Q7075": "library", "Q24354": "hall", "Q2087181": "heritage_center", "Q1081138": "memorial", "Q5003624": "memorial",
    "Q160742": "archive", "Q46169": "necropolis", "Q39614": "cemetery", "Q16970": "church_ancient", "Q32815": "place_of_worship", "Q34627": "synagogue_ancient", "Q44613": "church_ancient",
    "Q23413": "fortification", "Q57821": "fortification", "Q1364900": "gallery",
}
RELEVANT_CLASSES = [
    "אתר ארכאולוגי", "תל", "עיר עתיקה", "מערת קבורה", "מערה", "אמת מים", "מטחנה", "אנדרטה", "פסל", "כנסייה", "בית כנסת", "מסגד", "מנזר", "ארכיון", "ארכיון קיבוצי", "ארכיון יישובי", "מוזיאון", "ספרייה",
    "תיאטרון", "תחנת רכבת", "מבנה רומי עתיק", "תיאטרון רומי", "שמורת טבע", "שמורת יער", "פארק לאומי", "גן לאומי", "יער", "כפר פלסטיני עקור", "יישוב לשעבר", "קרב", "בית קברות", "אתר מורשת", "מבצר",
    "בית עלמין", "גשר היסטורי", "מבנה היסטורי", "אתר היסטורי", "מגדל מים",
]
INSTITUTION_TYPES = {
    "museum": "museum", "heritage_museum": "museum", "public_library": "library", "public_library_branch": "library", "gallery": "gallery", "studio_gallery": "studio_collective",
    "permanent_exhibition": "gallery", "artist_collective": "studio_collective", "performance_hall": "hall", "culture_hall": "hall", "culture_venue": "other_culture", "amphitheatre": "amphitheater",
    "heritage_visitor_centre": "visitor_center", "heritage_visitor_site": "visitor_center", "heritage_experience_centre": "visitor_center", "culture_and_heritage_centre": "heritage_center",
    "young_adult_community_centre": "community_culture_center", "community_centre": "community_culture_center", "arts_school": "art_school", "arts_school_branch": "art_school",
    "conservatory": "conservatory", "archive": "archive", "cinema": "cinema", "registered_culture_nonprofit": "other_culture",
}

# Planning designations, approved stages and kinds of protected areas.
DESIGNATIONS_LISTED = ["מבנה לשימור", "בלוק מבנה לשימור", "אתר/מתחם לשימור", "בלוק אתר לשימור ומספרו", "אתר עתיקות/אתר הסטורי", "שטח עתיקות/הסטורי לשימור", "שימור נופי"]
APPROVED_STAGES = ["אישור", "הכרעה בהתנגדויות / אישור"]
PROTECTED_KINDS = {
    "גן לאומי": "national_park", "גן לאומי שנוסף בתכנית זו": "national_park", "שמורת טבע": "nature_reserve", "שמורה שנוספה בתכנית זו": "nature_reserve", "שמורת נוף": "nature_reserve", "שמורת יער": "forest",
}
COUNCIL = "עמק יזרעאל"
