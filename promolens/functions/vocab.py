"""Controlled vocabularies. Results depend on each entry and on its order."""

STRONG = [
    "happy hour", "discount", "% off", "half off", "half price", "half-price", "no cover", "no charge", "complimentary", "on us",
    "early entry", "early bird", "matinee", "twilight", "cover charge", "free before", "free admission", "drink special", "drink deal",
    "cocktail special", "beer special", "wine special", "well drink", "well shot", "rail drink", "shot special", "2 for 1", "two for one",
    "bogo", "open bar", "live music", "live band", "live entertainment", "live performance", "performing live", "open mic", "dj night",
    "karaoke", "free show", "free concert", "entertainment night", "music night", "band night", "show tonight", "doors open", "guest list",
    "guestlist", "vip entry", "reduced cover", "early admission", "skip the line", "group rate", "group ticket", "group pricing",
    "group minimum", "birthday package", "book your group", "season pass", "annual pass", "day pass", "promo", "coupon", "save ",
    "summer special", "lunch special", "dinner special", "weekly special", "today's special", "chef's special", "daily special",
    "available now", "limited time", "while supplies last", "$",
]
WEAK = [
    "special", "deal", "free", "offer", "sale", "reward", "admission", "ticket", "wristband", "pass", "domestic", "house wine",
    "draft beer", "craft beer", "margarita", "bucket", "pitcher", "acoustic", "concert", "performing", "arrive early", "line pass",
    "party of", "private event", "corporate event", "team outing", "large party", "daily", "weekly", "every ", "tonight", "nightly",
    "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday", " off", "per person", "per game", "per lane", "pricing",
    "unlimited", "booking", "tasting", "slurpee", "student", "senior", "military",
]
BOILERPLATE = [
    "start your free trial", "copyright", "all rights reserved", "privacy policy", "terms of use", "terms of service", "cookie policy",
    "share its core values", "what this site has to offer", "story behind the business", "focus on the value this business",
    "describe what this site", "excellent place to share", "powered by wix", "powered by squarespace", "powered by wordpress", "built with",
    "website builder", "create your website", "sign up for free", "log in to your account", "subscribe to our newsletter",
    "join our mailing list", "membership", "member sign", "member login", "become a member", "join as a member", "membership plan",
    "membership fee", "monthly membership", "annual membership", "member benefits", "members only", "member exclusive", "member pricing",
    "membership required", "membership includes",
]
NAVIGATION = [
    "more info", "learn more", "click here", "contact us", "book now", "sign up", "subscribe", "privacy policy", "terms of use", "our events",
    "event calendar", "view all", "see all", "read more", "book your", "shop now", "order now", "find us", "get directions", "follow us",
    "join our", "join us on", "skip to", "back to top", "cookie policy", "all rights reserved", "link to", "click to", "perfect venue",
    "the ideal venue", "perfect place for", "host your", "private dining", "event space", "venue hire", "open for lunch", "open for dinner",
    "open daily for", "serving breakfast", "serving lunch", "serving dinner", "hours of operation", "business hours", "explore our",
    "discover our", "check out our",
]
#: pattern, bonus
QUALITY = [
    (r"\$\d", 0.20), (r"\d+\s*%", 0.20), (r"\d{1,2}(:\d{2})?\s*(am|pm)", 0.15), (r"\b(mon|tue|wed|thu|fri|sat|sun)(day)?\b", 0.10),
    (r"\b(daily|weekly|every)\b", 0.10), (r"\b(off|save|free|no cover|no charge)\b", 0.10),
]
PAGE_KEYWORDS = [
    "happy hour", "discount", "deal", "special", "promo", "live music", "no cover", "% off", "half off", "early entry", "matinee",
    "early bird", "cover charge", "admission", "save", "unlimited", "twilight", "tasting", "wristband", "group booking", "group event",
    "wednesday", "thursday", "friday", "saturday", "sunday",
]
FREE = r"(?i)(?<!gluten[- ])(?<!sugar[- ])(?<!duty[- ])(?<!toll[- ])(?<!fat[- ])(?<!risk[- ])(?<!hassle[- ])(?<!free[- ])\bfree\b"
DEALS = [
    "happy hour", "discount", "deal", "special", "promo", "free", "no cover", "% off", "half off", "cover charge", "admission", "save",
    "unlimited", "early entry", "matinee", "early bird", "twilight", "group booking", "wristband", "guest list",
]
FOOD = r"(?i)\b(gluten.?free|vegetarian|vegan|entree|appetizer|salad|soup|pasta|burger|sandwich|tacos?|pizza|sushi|steak|chicken|salmon|shrimp|fries|dessert|brunch menu|add.on|sides?|combo|platter)\b"
LIMITED = ["limited time", "while supplies last", "today only", "tonight only", "one night only", "expires", "ends soon", "last chance"]
HINTS = {
    "live music": "Live Music", "live band": "Live Music", "live entertainment": "Live Music", "performing live": "Live Music",
    "open mic": "Live Music", "acoustic": "Live Music", "dj night": "Live Music", "free show": "Live Music", "free concert": "Live Music",
    "music night": "Live Music", "band night": "Live Music", "entertainment night": "Live Music", "doors open": "Early Entry",
    "guest list": "Early Entry", "guestlist": "Early Entry", "early admission": "Early Entry", "reduced cover": "Early Entry",
    "cover charge": "Early Entry", "free before": "Early Entry", "skip the line": "Early Entry", "vip entry": "Early Entry",
    "happy hour": "Happy Hour", "drink special": "Happy Hour", "cocktail special": "Happy Hour", "beer special": "Happy Hour",
    "wine special": "Happy Hour", "well drink": "Happy Hour", "2 for 1": "Happy Hour", "two for one": "Happy Hour", "bogo": "Happy Hour",
    "half price": "Happy Hour", "open bar": "Happy Hour", "margarita": "Happy Hour", "draft beer": "Happy Hour",
    "group rate": "Group Booking", "group ticket": "Group Booking", "group pricing": "Group Booking", "private event": "Group Booking",
    "corporate event": "Group Booking", "book your group": "Group Booking", "birthday package": "Group Booking",
    "matinee": "Matinee Deal", "twilight": "Matinee Deal", "early show": "Matinee Deal", "daytime rate": "Matinee Deal",
    "per game": "Matinee Deal", "per lane": "Matinee Deal", "no cover": "Free", "no charge": "Free", "free admission": "Free",
    "complimentary": "Free", "season pass": "Discount", "annual pass": "Discount", "day pass": "Discount", "student": "Discount",
    "military": "Discount", "senior": "Discount",
}
MOTIVATORS = {"Happy Hour": "Value", "Discount": "Value", "Matinee Deal": "Value", "Free": "Free", "Early Entry": "FOMO", "Live Music": "Social", "Group Booking": "Social"}
URGENT = r"\b(limited time|tonight only|today only|last chance|selling fast|few left|exclusive event)\b"
TIMED = r"(?i)\b(mon|tue|wed|thu|fri|sat|sun|daily|nightly|weekday|weekend|\d{1,2}(:\d{2})?\s*(am|pm)|every\s+(monday|tuesday|wednesday|thursday|friday|saturday|sunday|week|night|day))\b"
BUSINESS_TYPES = {
    "american_restaurant": "American", "bar": "Bar", "bar_and_grill": "Bar & Grill", "barbecue_restaurant": "BBQ",
    "breakfast_restaurant": "Breakfast", "brunch_restaurant": "Brunch", "burger_restaurant": "Burgers", "cafe": "Cafe",
    "chinese_restaurant": "Chinese", "coffee_shop": "Coffee", "fast_food_restaurant": "Fast Food", "fine_dining_restaurant": "Fine Dining",
    "greek_restaurant": "Greek", "indian_restaurant": "Indian", "italian_restaurant": "Italian", "japanese_restaurant": "Japanese",
    "korean_restaurant": "Korean", "mediterranean_restaurant": "Mediterranean", "mexican_restaurant": "Mexican",
    "middle_eastern_restaurant": "Middle Eastern", "pizza_restaurant": "Pizza", "pub": "Pub", "ramen_restaurant": "Ramen",
    "restaurant": "Restaurant", "seafood_restaurant": "Seafood", "steak_house": "Steakhouse", "sushi_restaurant": "Sushi",
    "thai_restaurant": "Thai", "vegan_restaurant": "Vegan", "vegetarian_restaurant": "Vegetarian", "wine_bar": "Wine Bar",
}
CUISINES = [
    ("pizza", "Pizza"), ("sushi", "Sushi"), ("ramen", "Ramen"), ("taco", "Mexican"), ("burrito", "Mexican"), ("burger", "Burgers"),
    ("bbq", "BBQ"), ("barbecue", "BBQ"), ("seafood", "Seafood"), ("steak", "Steakhouse"), ("wine bar", "Wine Bar"), ("coffee", "Coffee"),
    ("cocktail", "Bar"), ("craft beer", "Bar"), ("brunch", "Brunch"), ("breakfast", "Breakfast"),
]
GROUP_SIGNALS = ["group", "party", "parties", "event", "events", "private", "reservation", "catering", "large", "corporate", "celebration", "gather", "gathering", "venue hire"]
GROUP_NEGATIVES = ["no reservations", "walk-in only", "counter service"]
DAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
PERIOD_WORDS = ["happy hour", "daily", "weekly", "nightly", "every", "each", *DAYS, "weekday", "weekend", "lunch", "dinner", "brunch"]
UNKNOWN = ["unknown", "", "needs extraction", "no incentive found", "—"]

AMOUNT = r"(?i)\$\s*(\d+(?:\.\d{1,2})?)\s*(off|discount|cover|admission|tickets?|beers?|drinks?|cocktails?|shots?|wines?|specials?)?"
DAY = r"(?:mon(?:day)?|tue(?:sday)?|wed(?:nesday)?|thu(?:rsday)?|fri(?:day)?|sat(?:urday)?|sun(?:day)?)"

# Pages, links and crawling.
LINK_KEYWORDS = [
    "happy-hour", "happyhour", "happy_hour", "specials", "special", "deals", "deal", "promo", "promotion", "offer", "offers", "discount",
    "live-music", "live-entertainment", "live_music", "entertainment", "music", "shows", "nightlife", "drink-specials", "drink_specials",
    "events", "menu", "drinks", "drink", "dining", "nightly", "weekly", "daily", "food-drink", "food-and-drink",
]
HERO_CLASSES = ["popup", "modal", "banner", "hero", "announcement", "promo", "alert", "marquee"]
SHELL_IDS = ["root", "app", "__next", "__nuxt", "gatsby-focus-wrapper", "react-root"]
HOURS = r"(?i)\b\d{1,2}(:\d{2})?\s*(am|pm)\b.*\b\d{1,2}(:\d{2})?\s*(am|pm)\b"
PATHS = ["/happy-hour", "/happyhour", "/specials", "/deals", "/entertainment", "/live-music", "/events", "/menu", ""]
STOP_PATHS = ["/happy-hour", "/happyhour", "/specials", "/deals", "/entertainment", "/live-music"]
ARCHIVE_PATHS = ["/specials", "/happy-hour", "/deals", "/events", ""]
EXTRA_PATHS = {
    "nightclub": ["/tickets", "/bottle-service", "/vip", "/admission", "/pricing"],
    "bar": ["/drink-specials", "/bar-specials", "/pricing", "/drinks-menu"],
    "live_music": ["/tickets", "/admission", "/pricing", "/shows"],
    "entertainment": ["/tickets", "/admission", "/pricing"],
}
META_NAMES = ["description", "og:description", "og:title", "og:site_name", "twitter:description", "twitter:title"]

# Search results.
AGGREGATORS = [
    "yelp.com", "tripadvisor.com", "google.com", "maps.google.com", "yellowpages.com", "foursquare.com", "zomato.com", "opentable.com",
    "happyhour.io", "doordash.com", "grubhub.com", "ubereats.com", "menupages.com", "allmenus.com", "restaurantji.com",
]
FAQ_NOISE = r"(?i)does .{3,50} have a happy hour\?|does .{3,50} serve alcohol\?|does .{3,50} take reservations\?|\d+ photos.{0,5}\d+ reviews"
NEARBY_TITLE = r"(?i)(top \d+ best|best .{3,30} near|happy hour near|specials near|restaurants near|bars near|updated 20\d\d)"
PRICE_TERMS = {
    "Early Entry": "cover charge admission price tickets", "Free": "cover charge admission price tickets",
    "Happy Hour": "drink prices happy hour menu specials", "Discount": "drink prices happy hour menu specials",
    "Live Music": "tickets admission cover charge price", "Group Booking": "group pricing packages price per person",
}
OTHER_PRICE_TERMS = "price admission tickets cover"

# Extraction and the cascade.
CATEGORIES = ["Happy Hour", "Live Music", "Early Entry", "Discount", "Free", "Group Booking", "Matinee Deal", "No Incentive"]
MEMBERSHIP = [
    "membership", "become a member", "member sign", "member login", "members only", "member exclusive", "membership plan",
    "membership fee", "monthly membership", "annual membership", "membership required", "membership includes", "member benefits",
    "join as a member", "member pricing",
]
LLM_LIMITED = ["limited time", "while supplies last", "today only", "tonight only", "expires"]
LLM_URGENT = r"\b(limited time|tonight only|today only|last chance|selling fast)\b"
NIGHTCLUB_TYPES, LIVE_MUSIC_TYPES = ["Nightclub", "Bar", "Entertainment", "Casino"], ["Live Music"]
EARLY_ENTRY_SIGNALS = r"(?i)\b(cover charge|no cover|free before|doors open|guest list|guestlist|early admission|vip entry|skip the line|reduced cover|wristband|tickets? (at|are) \$|buy tickets?)\b"
LIVE_MUSIC_SIGNALS = r"(?i)\b(live (music|band|entertainment|show|performance)|performing live|open mic|acoustic (set|night)|dj set|dj night|music night|band night|concert|touring artist)\b"
#: In this order; a later pattern gives way to what an earlier one has taken.
TIMES = [
    r"\b(monday|tuesday|wednesday|thursday|friday|saturday|sunday)s?\s*(?:[-–&]|to|through)\s*(monday|tuesday|wednesday|thursday|friday|saturday|sunday)s?\b",
    r"\b(mon|tue|wed|thu|fri|sat|sun)\s*(?:[-–&]|to|through)\s*(mon|tue|wed|thu|fri|sat|sun)\b",
    r"\b(monday|tuesday|wednesday|thursday|friday|saturday|sunday)s?\b",
    r"\b(mon|tue|wed|thu|fri|sat|sun)\b",
    r"\b\d{1,2}(:\d{2})?\s?(am|pm)\s*[-–to]+\s*\d{1,2}(:\d{2})?\s?(am|pm)\b",
    r"\b\d{1,2}(:\d{2})?\s?(am|pm)\b",
    r"\b([01]\d|2[0-3]):[0-5]\d\b",
    r"\b(noon|midnight|lunchtime?|brunch|dinner|happy hour|opening|closing)\b",
    r"\b(all day|all night|all week)\b",
    r"\b(daily|nightly|weekdays|weekends|weekly)\b",
    r"\b(every|each)\s+(monday|tuesday|wednesday|thursday|friday|saturday|sunday|week|weekend|weekday|night|day|month|hour|visit|show|game|event)\b",
    r"\b(tonight|today|this\s+(friday|saturday|sunday|weekend|week))\b",
    r"\b(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|jun(?:e)?|jul(?:y)?|aug(?:ust)?|sep(?:tember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)\s+\d{1,2}\b",
]

# Label maps.
BROAD = {
    "Live Music": ["Live Music", "Free Live Music", "Live Music Nights", "Summer Concert Series", "Free Concert Series", "Free Concert Nights", "Free Entertainment", "Free Music", "Free Show Entry", "Happy Hour Show", "Live Music Happy Hour", "Free Street Events"],
    "Early Entry": ["Early Entry", "Early Entry + Drink"],
    "Group Booking": ["Group Booking", "Group Discount", "Group Rental", "Group Tour", "Group Dive", "Group Deal", "Group Charter"],
    "Matinee Deal": ["Matinee Deal", "Twilight Ticket", "Twilight Admission", "Twilight Deal"],
    "Happy Hour": ["Happy Hour", "Taco Tuesday", "Lunch Special", "Lunch Bento", "Afternoon Deal", "Early Bird Dining", "Lunch Bowl Deal", "Lunch Combo", "Early Bird Dinner"],
    "Free": ["Free", "Free Day", "Free Hot Dog Day", "Free Root Beer Float Day", "Pay What You Can", "Slurpee Deal", "Family Deal", "Free Events", "Free Community Event", "Free Tour Day", "Free Entry"],
    "Discount": [
        "Discount", "Early Bird Ticket", "Early Bird", "Combo Deal", "Night Strike", "Discount Days", "Unlimited Bowling", "Tasting Deal", "Unlimited Play", "After Hours", "Player Reward", "Day Pass", "First Time Discount",
        "24-Hour Access", "Military Discount", "After 3 PM Deal", "Ride Wristband", "Student Discount", "Hiking Deal", "Night Strike + Food", "Unlimited Play Package", "Secret Menu Deal", "Unlimited Jump",
    ],
    "No Incentive": ["No Incentive"],
}
#: Comparison reports know one label more.
COMPARED_ONLY = {"Group Friendly": "Group Booking"}
MOTIVATOR_CLASSES = {
    "Value": "Value", "Value / Social": "Value", "Value / Scarcity": "Value", "Free / Social": "Free", "Urgency": "FOMO", "Group / Value": "Social",
    "Free / Scarcity": "Free", "Social": "Social", "Savings": "Value", "Free": "Free", "Exclusivity": "Exclusivity", "FOMO": "FOMO",
}
RELABEL_MOTIVATORS = {
    "Live Music": "Free / Social", "Early Entry": "Urgency", "Group Booking": "Group / Value", "Matinee Deal": "Value", "Happy Hour": "Value",
    "Free": "Free / Social", "Discount": "Value",
}
VENUE_TYPES = {
    "Live Music": ["Live Music Venue", "Live Music & Dining", "Live Music & Bar", "American / Live Music", "Live Music / American", "Live Music / Bar", "Live Music"],
    "Nightclub": ["Nightclub", "Nightclub & Dining", "Nightclub / Bar"],
    "Theater": ["Theater", "Theater & Dining"],
    "Entertainment": ["Entertainment", "Entertainment Venue", "Outdoor Entertainment", "Outdoor Entertainment & Dining"],
    "Bowling": ["Bowling", "Bowling & Dining"],
    "Museum": ["Museum"],
    "Movie Theater": ["Movie Theater", "Movie Theater & Dining"],
    "Aquarium": ["Aquarium"],
    "Comedy Club": ["Comedy Club"],
    "Casino": ["Casino"],
    "Dining": ["Dining", "Dining & Bar", "Dining & Live Music"],
}
#: What training and serving map beyond these, each in its own way.
TRAINED_TYPES = {
    "Nightclub & Bar": "Nightclub", "Dining & Nightclub": "Dining", "Garden / Entertainment": "Entertainment", "American / Bar": "Dining", "American / Lounge": "Dining",
    "Hawaiian / Poke": "Dining", "Pizza / Casual Dining": "Dining", "Sandwiches / Cafe": "Dining", "Korean / Fast Casual": "Dining",
}
SERVED_TYPES = {"Dining & Nightclub": "Nightclub", "bar": "Dining", "restaurant": "Dining", "Bar": "Dining"}
COMPARED = [
    "Incentive Category", "Cuisine / Experience Category", "Days / Timing Restrictions", "Group Friendly?", "Psychological Motivator Type",
    "Estimated Perceived Value ($ range)", "Expiration / Ongoing",
]

# Chunks of crawled pages.
CHUNK_KEYWORDS = [
    "happy hour", "discount", "deal", "deals", "special", "specials", "promo", "promotion", "offer", "offers", "coupon", "free", "no cover", "no charge",
    "complimentary", "half off", "half price", "% off", "save", "bogo", "2 for 1", "two for one", "early bird", "early entry", "matinee", "twilight",
    "admission", "cover charge", "ticket", "tickets", "wristband", "live music", "live band", "live entertainment", "open mic", "karaoke", "dj night",
    "concert", "group rate", "group pricing", "group discount", "party package", "birthday package", "private event", "unlimited", "tasting", "student",
    "senior", "military", "member", "loyalty", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday", "$",
]
CHUNK_LINKS = [
    "happy-hour", "happyhour", "happy_hour", "specials", "special", "deals", "deal", "promo", "promotion", "offers", "offer", "discount", "coupons", "menu",
    "drinks", "drink", "bar", "events", "event", "live-music", "live-entertainment", "music", "shows", "tickets", "admission", "pricing", "packages", "groups",
    "party", "birthday",
]
NOISE = [
    "privacy policy", "terms of use", "cookie policy", "all rights reserved", "sign up", "subscribe", "follow us", "contact us", "get directions",
    "read more", "learn more", "view all", "book now", "order now",
]
CHUNK_FOOD = ["burger", "pizza", "taco", "tacos", "salad", "soup", "steak", "chicken", "pasta", "sushi", "fries", "dessert", "appetizer", "entree", "gluten free", "vegetarian", "vegan"]
CHUNK_DEALS = ["deal", "special", "discount", "happy hour", "half off", "free", "promo", "offer"]
STALE = ["domain for sale", "buy this domain", "parkingcrew", "sedo", "this domain is parked"]
GOLD_FIELDS = ["venue_name", "Source URL", "Business Type", "Incentive Category", "Incentive Teaser", "Full Incentive Description"]
