"""Rule tables.

FIXED VALUES. Everything in this module must equal the behaviour we rebuild
(thresholds, weights, keyword lists, labels). They are kept plain, in their
natural order, and every operator takes them as parameters so callers can
pass their own tables.
"""

from __future__ import annotations

# ---------------------------------------------------------------- FIXED VALUES
# Preference name -> recommendation signal column (order matters for texts).
PREFERENCE_COLUMNS = {
    "food": "food_recommendation_signal",
    "nightlife": "nightlife_recommendation_signal",
    "culture": "culture_recommendation_signal",
    "nature": "nature_recommendation_signal",
    "beach": "beach_recommendation_signal",
}

# Order in which the natural sentence lists preferences >= 7 (request order).
REQUEST_PREFERENCE_ORDER = ["food", "beach", "culture", "nature", "nightlife"]

BUDGET_MATCH_MATRIX = {
    "Low (Essential)": {"Budget": 100, "Mid-range": 65, "Luxury": 25},
    "Medium (Comfort)": {"Budget": 75, "Mid-range": 100, "Luxury": 70},
    "High (Luxury)": {"Budget": 60, "Mid-range": 85, "Luxury": 100},
}
DEFAULT_BUDGET = "Medium (Comfort)"
UNKNOWN_LEVEL_BUDGET_SCORE = 70
MISSING_COST_LEVEL = "Mid-range"

MONTH_TO_SEASON = {
    "january": "winter",
    "february": "winter",
    "march": "spring",
    "april": "spring",
    "may": "spring",
    "june": "summer",
    "july": "summer",
    "august": "summer",
    "september": "autumn",
    "october": "autumn",
    "november": "autumn",
    "december": "winter",
}

SEASON_MONTHS = {
    "winter": [12, 1, 2],
    "spring": [3, 4, 5],
    "summer": [6, 7, 8],
    "autumn": [9, 10, 11],
}
SEASONS = ["winter", "spring", "summer", "autumn"]

WEATHER_COMFORT_PROFILES = {
    "warm": {"ideal_temp": 27, "tolerance": 5},
    "mild": {"ideal_temp": 21, "tolerance": 4},
    "cool": {"ideal_temp": 15, "tolerance": 4},
}
DEFAULT_WEATHER_PREFERENCE = "Any"

# Score weights of the final recommendation score.
SCORE_WEIGHTS = {"preference": 0.60, "weather": 0.20, "cost": 0.15}
CLUSTER_BONUS = 5
MUST_HAVE_THRESHOLD = 7
MUST_HAVE_SIGNAL_FLOOR = 40
MUST_HAVE_PENALTY_SCALE = 30
BEACH_PROFILE_PENALTY = 8
NATURE_URBAN_PENALTY = 6

PROFILE_WARM_COASTAL = "Warm Coastal & Beach"
PROFILE_URBAN = "Urban Culture & Food"
PROFILE_COOL_NATURE = "Cool Balanced & Nature"
CLUSTER_PROFILES = [PROFILE_WARM_COASTAL, PROFILE_URBAN, PROFILE_COOL_NATURE]

# Places: output count column -> (tag key, tag value).
PLACE_FEATURES = {
    "restaurant_count": ("amenity", "restaurant"),
    "cafe_count": ("amenity", "cafe"),
    "bar_count": ("amenity", "bar"),
    "museum_count": ("tourism", "museum"),
    "park_count": ("leisure", "park"),
    "nearby_beach_count": ("natural", "beach"),
}
PLACE_COUNT_COLUMNS = list(PLACE_FEATURES)

SCORE_FEATURES = {
    "food_score": ["restaurant_count", "cafe_count"],
    "nightlife_score": ["bar_count"],
    "culture_score": ["museum_count"],
    "nature_score": ["park_count"],
    "beach_score": ["nearby_beach_count"],
}
SCORE_COLUMNS = list(SCORE_FEATURES)

SEARCH_RADIUS_METERS = 3000
DESTINATION_TYPE_RADIUS_METERS = {
    "city": 3000,
    "coastal_city": 8000,
    "mountain": 5000,
    "island": 15000,
    "region": 15000,
}
DESTINATION_TYPES = ["city", "coastal_city", "mountain", "island", "region"]

DESTINATION_TYPE_OVERRIDES = {
    "Kefalonia": "island",
    "Santorini": "island",
    "Funchal": "island",
    "Mallorca": "island",
    "Sardinia": "island",
    "Dubrovnik": "coastal_city",
    "Split": "coastal_city",
    "Lisbon": "coastal_city",
    "Barcelona": "coastal_city",
    "Nice": "coastal_city",
    "Amalfi": "coastal_city",
    "Cinque Terre": "region",
    "Interlaken": "mountain",
    "Zermatt": "mountain",
    "Lake Bled": "mountain",
}

ISLAND_DESTINATIONS = ["Kefalonia", "Mallorca", "Sardinia", "Santorini"]
MOUNTAIN_DESTINATIONS = ["Interlaken", "Zermatt", "Lake Bled"]
COASTAL_DESTINATIONS = [
    "Kefalonia", "Santorini", "Funchal", "Mallorca", "Sardinia", "Dubrovnik",
    "Split", "Nice", "Amalfi", "Cinque Terre", "Amsterdam",
]
COASTAL_TYPES = ["coastal_city", "island", "region"]

# Climate thresholds.
WARM_SUMMER_TEMP = 24
COLD_WINTER_TEMP = 5
SUMMER_MAX_RAIN = 1.5
RAIN_RISK_RAIN = 3
CLIMATE_WARM_WINTER = 10
CLIMATE_COOL_SUMMER = 22
CLIMATE_COOL_WINTER = 2
CITY_PERCENTILE = 0.6
BALANCED_STD = 15
STYLE_MARGIN = 10

# Bucketiser rules: (upper bound, inclusive?, label) tried in order; else default.
COST_OF_LIVING_LEVELS = [(45, False, "Budget"), (65, True, "Mid-range")]
COST_OF_LIVING_DEFAULT = "Luxury"
TRAVEL_COST_LEVELS = [(35, False, "Budget"), (65, True, "Mid-range")]
TRAVEL_COST_DEFAULT = "Luxury"
UNKNOWN_LEVEL = "Unknown"

# Level labels on results: (lower bound inclusive, label) from the top; else default.
BEACH_ACCESS_LEVELS = [(60, "Excellent"), (21, "High"), (6, "Moderate")]
BEACH_ACCESS_DEFAULT = "Low"
SCORE_LEVELS = [(80, "Excellent"), (60, "High"), (35, "Moderate")]
SCORE_LEVEL_DEFAULT = "Limited"
WEATHER_LEVELS = [(80, "Excellent"), (60, "Good"), (35, "Mixed")]
WEATHER_LEVEL_DEFAULT = "Limited"
BUDGET_LEVELS = [(80, "Excellent"), (50, "Good")]
BUDGET_LEVEL_DEFAULT = "Limited"

FRIENDLY_CLUSTER_LABELS = {
    "Warm Coastal & Beach": "Warm Coastal Escape",
    "Urban Culture & Food": "Culture & Food City",
    "Cool Balanced & Nature": "Nature Retreat",
}

BEST_FOR_TEXT = {
    "Warm Coastal & Beach": "Beach holidays and relaxing coastal breaks",
    "Urban Culture & Food": "City breaks, food, museums, and urban exploring",
    "Cool Balanced & Nature": "Nature, hiking, scenic views, and quieter escapes",
}
BEST_FOR_DEFAULT = "Balanced trips"

# Guide of a destination, and the values where a guide or one of its fields is missing (fixed values).
DESTINATION_GUIDES = {
    "Mallorca": {
        "airport": "Palma de Mallorca Airport",
        "stay": "5-7 days",
        "best_months": "May, June, September",
        "dont_miss": ["Palma Cathedral", "Valldemossa", "Soller", "Cap de Formentor", "Cala d'Or"],
        "highlights": ["Clear coastal coves", "Scenic villages", "Mediterranean food", "Easy day trips"],
        "good_to_know": ["Budget: medium", "Crowds: high in August", "Driving: recommended"],
    },
    "Nice": {
        "airport": "Nice Cote d'Azur Airport",
        "stay": "3-5 days",
        "best_months": "May, June, September",
        "dont_miss": ["Promenade des Anglais", "Old Nice", "Castle Hill", "Cours Saleya", "Villefranche-sur-Mer"],
        "highlights": ["Beach promenade", "Excellent food scene", "Easy Riviera day trips", "Warm weather"],
        "good_to_know": ["Budget: medium-high", "Crowds: high in summer", "Transport: strong train links"],
    },
    "Split": {
        "airport": "Split Airport",
        "stay": "4-6 days",
        "best_months": "May, June, September",
        "dont_miss": ["Diocletian's Palace", "Marjan Hill", "Riva promenade", "Hvar day trip", "Trogir"],
        "highlights": ["Historic old town", "Island day trips", "Coastal walks", "Lively food scene"],
        "good_to_know": ["Budget: medium", "Crowds: high in July-August", "Ferries: very useful"],
    },
    "Lisbon": {
        "airport": "Humberto Delgado Airport",
        "stay": "4-6 days",
        "best_months": "April, May, September",
        "dont_miss": ["Alfama", "Belem Tower", "LX Factory", "Sintra day trip", "Time Out Market"],
        "highlights": ["Food and cafes", "Viewpoints", "Historic neighborhoods", "Coastal day trips"],
        "good_to_know": ["Budget: medium", "Hills: expect walking", "Transport: metro and trams"],
    },
    "Cinque Terre": {
        "airport": "Pisa International Airport",
        "stay": "3-4 days",
        "best_months": "May, June, September",
        "dont_miss": ["Monterosso", "Vernazza", "Manarola", "Corniglia", "Coastal hiking trails"],
        "highlights": ["Colorful villages", "Coastal hiking", "Sea views", "Local seafood"],
        "good_to_know": ["Budget: medium", "Crowds: high mid-summer", "Transport: use the train"],
    },
    "Kefalonia": {
        "airport": "Kefalonia International Airport",
        "stay": "5-7 days",
        "best_months": "June, September",
        "dont_miss": ["Myrtos Beach", "Assos", "Fiskardo", "Melissani Cave", "Antisamos Beach"],
        "highlights": ["Relaxed beaches", "Scenic villages", "Clear water", "Nature drives"],
        "good_to_know": ["Budget: medium", "Driving: recommended", "Pace: relaxed"],
    },
    "Sardinia": {
        "airport": "Cagliari Elmas Airport",
        "stay": "7-10 days",
        "best_months": "June, September",
        "dont_miss": ["Cagliari", "Costa Smeralda", "La Maddalena", "Alghero", "Cala Gonone"],
        "highlights": ["Dramatic coastline", "Nature access", "Regional food", "Road trips"],
        "good_to_know": ["Budget: medium-high", "Driving: recommended", "Distances: plan carefully"],
    },
    "Barcelona": {
        "airport": "Barcelona-El Prat Airport",
        "stay": "4-6 days",
        "best_months": "April, May, September",
        "dont_miss": ["Sagrada Familia", "Gothic Quarter", "Park Guell", "Barceloneta", "Casa Batllo"],
        "highlights": ["Architecture", "Food and nightlife", "Urban beach", "Museums"],
        "good_to_know": ["Budget: medium-high", "Crowds: high", "Transport: excellent metro"],
    },
    "Paris": {
        "airport": "Charles de Gaulle Airport",
        "stay": "4-7 days",
        "best_months": "April, May, September",
        "dont_miss": ["Louvre", "Eiffel Tower", "Montmartre", "Seine walk", "Le Marais"],
        "highlights": ["Museums", "Food scene", "Iconic neighborhoods", "Walkability"],
        "good_to_know": ["Budget: high", "Book museums ahead", "Transport: excellent metro"],
    },
    "Amsterdam": {
        "airport": "Amsterdam Schiphol Airport",
        "stay": "3-5 days",
        "best_months": "April, May, September",
        "dont_miss": ["Canal Ring", "Rijksmuseum", "Jordaan", "Anne Frank House", "Vondelpark"],
        "highlights": ["Canals", "Museums", "Cycling", "Compact city center"],
        "good_to_know": ["Budget: high", "Book popular museums ahead", "Transport: bike and tram"],
    },
}
GUIDE_DEFAULT = {
    "airport": "Main regional airport",
    "stay": "3-5 days",
    "best_months": "May, June, September",
    "dont_miss": ["Old town", "Local viewpoints", "Food markets", "Day trips"],
    "highlights": ["Good seasonal fit", "Balanced travel experience", "Local food", "Walkable areas"],
    "good_to_know": ["Budget: varies", "Book ahead in peak season", "Check local transport"],
}

# Travel costs.
PRICE_ITEM_KEYWORDS = {
    "restaurant_meal_price_eur": ["Meal, Inexpensive Restaurant"],
    "cappuccino_price_eur": ["Cappuccino"],
    "local_transport_price_eur": ["One-way Ticket"],
    "groceries_basket_price_eur": [
        "Loaf of Fresh White Bread", "Eggs", "Milk", "Apples", "Potato", "Lettuce",
    ],
}

TRAVEL_COST_WEIGHTS = {
    "hotel_price_score": 0.45,
    "restaurant_price_score": 0.20,
    "cafe_price_score": 0.10,
    "groceries_price_score": 0.10,
    "attraction_price_score": 0.10,
    "transport_price_score": 0.05,
}
TRAVEL_COST_SCORE_SOURCES = {
    "hotel_price_score": "median_hotel_price_eur",
    "restaurant_price_score": "restaurant_meal_price_eur",
    "cafe_price_score": "cappuccino_price_eur",
    "groceries_price_score": "groceries_basket_price_eur",
    "attraction_price_score": "museum_or_attraction_price_eur",
    "transport_price_score": "local_transport_price_eur",
}
MAX_HOTELS = 20
ATTRACTION_COVERAGE_NOTE = "not_collected_v2"

# Preference translation.
TRIP_STYLES = {
    "Beach Holiday": {"food": 6, "beach": 10, "culture": 2, "nature": 5, "nightlife": 2},
    "City Break": {"food": 7, "beach": 1, "culture": 9, "nature": 3, "nightlife": 6},
    "Nature & Hiking": {"food": 4, "beach": 3, "culture": 3, "nature": 10, "nightlife": 1},
    "Food & Wine": {"food": 10, "beach": 2, "culture": 5, "nature": 3, "nightlife": 4},
    "Nightlife With Friends": {"food": 7, "beach": 3, "culture": 3, "nature": 2, "nightlife": 10},
    "Balanced Trip": {"food": 6, "beach": 6, "culture": 6, "nature": 6, "nightlife": 4},
}

ACTIVITY_WEIGHTS = {
    "Beach": {"beach": 3},
    "Local food": {"food": 3},
    "Museums": {"culture": 3},
    "Nature": {"nature": 3},
    "Wine": {"food": 2, "culture": 1},
    "Nightlife": {"nightlife": 3, "food": 1},
    "Hiking": {"nature": 3},
    "Photography": {"culture": 1, "nature": 2},
}

TRAVEL_COMPANION_WEIGHTS = {
    "Solo": {"culture": 2, "food": 1},
    "Partner": {"beach": 2, "food": 2, "nightlife": 1},
    "Friends": {"nightlife": 3, "food": 2},
    "Family": {"nature": 2, "culture": 1, "nightlife": -2},
}

KEYWORD_WEIGHTS = {
    "beach": {
        "terms": ["beach", "beaches", "plaja", "plaje", "sea", "seaside", "coast", "coastal", "swim", "swimming"],
        "weights": {"beach": 3},
    },
    "food": {
        "terms": ["food", "restaurant", "restaurants", "local food", "cuisine", "dining", "eat", "eating", "wine"],
        "weights": {"food": 3},
    },
    "culture": {
        "terms": ["museum", "museums", "history", "historic", "culture", "architecture", "old town", "monuments"],
        "weights": {"culture": 3},
    },
    "nature": {
        "terms": [
            "nature", "hike", "hiking", "trek", "trekking", "trail", "trails", "mountain",
            "mountains", "lake", "parks", "scenic", "landscape", "outdoors",
        ],
        "weights": {"nature": 3},
    },
    "nightlife": {
        "terms": ["nightlife", "party", "club", "clubs", "bar", "bars", "friends"],
        "weights": {"nightlife": 3},
    },
    "relax": {
        "terms": ["relax", "relaxing", "quiet", "peaceful", "romantic", "chill", "slow"],
        "weights": {"beach": 1, "nature": 1},
    },
}

TEXT_WEATHER_KEYWORDS = {
    "Warm": ["warm", "hot", "sunny", "sun", "summer", "heat", "beach weather"],
    "Mild": [
        "mild", "moderate", "pleasant", "walkable", "not too hot", "good weather",
        "nice weather", "weather good", "good enough",
    ],
    "Cool": ["cool", "cold", "chilly", "fresh", "snow", "winter"],
}
WEATHER_OPTIONS = ["Warm", "Mild", "Cool", "Any"]

FUZZY_RATIO = 0.84
FUZZY_MIN_TERM_LENGTH = 4
PREFERENCE_MIN = 0
PREFERENCE_MAX = 10

# Machine learning.
MODEL_FEATURES = [
    "restaurant_count",
    "cafe_count",
    "bar_count",
    "museum_count",
    "park_count",
    "nearby_beach_count",
    "summer_avg_temp",
    "summer_avg_daily_rain",
]
K_VALUES = [2, 3, 4, 5, 6]
RANDOM_STATE = 42
N_INIT = 20
MAX_ITER = 300
DBSCAN_EPS = [1.2, 1.5, 2.0]
DBSCAN_MIN_SAMPLES = 2

# Map layers: (layer name, score column, colour when score >= 80).
MAP_LAYERS = [
    ("Summer Weather Score", "summer_weather_score", "green"),
    ("Beach Score", "beach_score", "blue"),
    ("Culture Score", "culture_score", "purple"),
]
# ------------------------------------------------------------ END FIXED VALUES

EARTH_RADIUS_M = 6_371_000.0  # our choice for the haversine distance
