"""Rule tables. Longer ones (tag maps) come as DataFrames or lists from the user."""

from __future__ import annotations

# Categories whose presence drops a record.
EXCLUDED = (
    "temple", "church", "mosque", "gurudwara", "synagogue", "shrine", "monastery", "religious_organization", "place_of_worship", "cemetery", "funeral_home",
    "landmark", "historical", "monument", "tourist_attraction", "museum", "park", "playground", "garden", "beach", "lake", "mountain", "forest",
    "bus_station", "train_station", "railway", "airport", "metro_station", "subway", "port", "ferry", "parking", "toll", "bridge",
    "government_office", "public_and_government_association", "embassy", "police", "fire_station", "court", "prison", "military",
    "political", "community_services_non_profits", "charity", "nonprofit", "neighborhood", "region", "city_hall", "public_plaza", "atms", "atm",
)

# Whole tokens that decide before the rules.
EXTRA_TOKENS = {"bookstore": "printing-and-stationery", "spas": "salons-and-spas", "gyms": "beauty-and-wellness", "banks": "professional-services"}

# The keyword rules, in order; None is recognised but no merchant.
KEYWORD_RULES = [
    (("pharmac", "drugstore", "chemist", "medical_supply"), "medical-stores-and-pharmacies"),
    (("hospital", "clinic", "doctor", "dentist", "physician", "surgeon", "diagnostic", "pathology", "nursing", "physiotherap", "ayurved", "homeopath", "optometr", "health_and_medical", "medical_center", "eye_care", "dermatolog", "pediatric", "gynecolog", "orthoped", "cardiolog", "psychiatr", "laborator"), "hospitals-and-clinics"),
    (("veterinar", "pet_", "_pet", "animal"), "pet-stores-and-pet-services"),
    (("bakery", "bakeries", "cake", "sweet_shop", "confection", "dessert", "patisserie", "ice_cream", "chocolat"), "bakeries-and-sweets"),
    (("restaurant", "cafe", "coffee", "food_court", "dhaba", "canteen", "bar_", "_bar", "pub", "brewery", "juice", "tea_", "fast_food", "pizza", "biryani", "catering", "food_and_drink", "eatery", "diner", "bistro", "tiffin"), "restaurants-and-food"),
    (("hotel", "resort", "lodge", "guest_house", "hostel", "accommodation", "homestay", "motel", "bnb", "serviced_apartment"), "hotels-and-accommodation"),
    (("grocery", "supermarket", "kirana", "convenience_store", "provision", "greengrocer", "butcher", "fish_market", "dairy", "beverage_store", "liquor", "wine_shop", "food_store", "general_store", "departmental"), "grocery-and-kirana"),
    (("mobile_phone", "cell_phone", "smartphone", "telecom_store"), "mobile-stores"),
    (("computer", "laptop", "it_store", "software_development", "information_technology", "web_design", "app_develop", "data_", "cyber"), "computer-and-laptop-stores"),
    (("electronics", "appliance", "television", "audio", "camera_store"), "electronics-stores"),
    (("hardware", "building_material", "cement", "sanitary", "tiles", "paint_store", "plywood", "timber", "steel", "glass_", "construction_material"), "hardware-stores"),
    (("electrical_store", "electrical_supply", "lighting"), "electrical-stores"),
    (("furniture", "mattress", "home_decor", "interior_design", "furnishing", "carpet", "curtain", "kitchenware", "houseware"), "furniture-stores"),
    (("clothing", "apparel", "boutique", "garment", "saree", "textile", "fabric", "fashion", "tailor", "readymade", "uniform"), "clothing-stores"),
    (("shoe_", "footwear", "sandal"), "footwear-stores"),
    (("jewel", "goldsmith", "silversmith", "watch_store", "gems"), "jewellery-stores"),
    (("salon", "spa", "barber", "hair_", "nail_", "massage", "parlour", "parlor"), "salons-and-spas"),
    (("beauty", "cosmetic", "gym", "fitness", "yoga", "wellness", "slimming", "meditation"), "beauty-and-wellness"),
    (("gas_station", "petrol", "fuel", "cng", "lpg", "charging_station"), "petrol-stations"),
    (("tyre", "tire", "battery_store"), "tyre-and-battery-stores"),
    (("motorcycle_repair", "bike_repair", "two_wheeler_repair", "scooter_repair"), "bike-repair"),
    (("automotive_repair", "car_repair", "car_wash", "auto_repair", "garage", "vehicle_repair", "denting"), "car-repair"),
    (("car_dealer", "motorcycle_dealer", "automotive", "auto_parts", "vehicle", "driving_school", "car_rental", "truck", "tractor_dealer"), "automobile-services"),
    (("preschool", "kindergarten", "elementary_school", "high_school", "primary_school", "secondary_school", "school"), "schools"),
    (("college", "university", "institute_of", "polytechnic"), "colleges"),
    (("tutoring", "coaching", "test_prep", "computer_coaching", "tuition"), "tuition-and-coaching"),
    (("education", "training", "library", "learning", "academy", "driving_range"), "education-and-training"),
    (("plumb",), "plumbing-services"),
    (("electrician", "electrical_service", "electrical_contractor"), "electrical-services"),
    (("cleaning", "housekeeping", "pest_control", "sanitation"), "cleaning-services"),
    (("laundry", "dry_clean", "home_service", "carpenter", "handyman", "gardening", "home_improvement", "appliance_repair"), "home-services"),
    (("repair", "servicing", "maintenance"), "repair-services"),
    (("courier", "post_office", "logistics", "packers", "movers", "delivery_service", "freight", "shipping"), "courier-and-parcel-services"),
    (("real_estate", "property", "home_developer", "builder", "apartment_rental", "land_", "estate_agent", "construction_services", "architect_"), "property-services"),
    (("travel", "tour_", "_tours", "tourist_information", "visa", "ticket"), "travel-services"),
    (("event", "wedding", "banquet", "party", "photograph", "videograph", "dj_", "cinema", "theatre", "entertainment", "amusement"), "event-services"),
    (("printing", "stationery", "photocopy", "xerox", "book_store", "bookshop", "internet_cafe", "cyber_cafe", "graphic_design", "advertising"), "printing-and-stationery"),
    (("gift", "florist", "flower", "toy_", "handicraft", "souvenir", "art_"), "gift-stores"),
    (("agricultur", "farm", "seed", "fertilizer", "pesticide", "nursery_plant", "irrigation", "poultry", "dairy_farm"), "agricultural-supplies"),
    (("wholesale", "distributor", "supplier", "trading_company", "importer", "exporter"), "wholesale-businesses"),
    (("manufactur", "factory", "industrial", "fabrication", "workshop_", "mill_", "processing", "engineering_works"), "local-manufacturers"),
    (("bank", "credit_union", "financial", "insurance", "loan", "lawyer", "legal", "accountant", "tax_", "chartered", "consult", "notary", "auditor", "broker", "professional_services", "business_services", "recruit", "staffing", "hr_", "marketing", "agency", "office_", "corporate", "company", "coworking"), "professional-services"),
    (("eyewear", "optician", "optical"), "hospitals-and-clinics"),
    (("physical_therapy", "naturopath", "counseling_and_mental_health", "chiroprac", "acupunctur", "rehabilitation", "wellness_program", "nutritionist", "dietitian"), "hospitals-and-clinics"),
    (("tattoo", "makeup_artist", "mehendi", "piercing", "waxing", "threading", "skin_care", "hair_removal"), "beauty-and-wellness"),
    (("caterer", "catering", "bar", "lounge", "banquet_food"), "restaurants-and-food"),
    (("auto_detailing", "car_detailing", "vehicle_wash"), "car-repair"),
    (("engineering_services", "architectural_designer", "surveying", "drafting", "interior_designer", "landscap"), "professional-services"),
    (("telecommunications", "internet_service_provider", "cable_provider", "money_transfer", "payment_service", "atm_service", "currency"), "professional-services"),
    (("business_to_business", "b2b_", "commercial_equipment", "industrial_equipment", "energy_equipment", "machinery"), "wholesale-businesses"),
    (("chemical_plant", "manufacturing_plant", "production_facility", "refinery", "packaging", "textile_mill"), "local-manufacturers"),
    (("astrolog", "psychic", "numerolog", "vastu", "palmist", "priest_service"), "professional-services"),
    (("music_production", "recording_studio", "arts_and_crafts", "art_gallery", "dance_studio", "event_venue", "concert_venue", "party_supplies"), "event-services"),
    (("tours", "tour_operator", "tour_agency", "holiday"), "travel-services"),
    (("social_service_organizations", "non_governmental_association", "community_center"), None),
    (("home_business", "home_baker", "homemade"), "home-businesses"),
    (("shopping", "store", "shop", "market", "mall", "retail", "outlet", "bazaar"), "other-local-businesses"),
]

# Trade words in Indian scripts, in order and case-sensitive; a later match overrides an earlier one where the category differs.
SCRIPT_RULES = [
    (r"ज्योतिष|ज्योतिषी|జ్యోతిష్య|జ్యోతిష్యాలయ|ஜோதிட|ಜ್ಯೋತಿಷ", "professional-services", "astrologer", "SERVICE_PROVIDER"),
    (r"मेडिकल|मेडिकल्स|दवाखाना|औषध|फार्मेसी|మెడికల్|మెడికల్స్|ఔషధ|மருந்தக|ಮೆಡಿಕಲ್|മെഡിക്കൽ|ওষুধ|મેડિકલ", "medical-stores-and-pharmacies", "chemist", "RETAIL_STORE"),
    (r"अस्पताल|चिकित्सालय|क्लिनिक|दवाखाना|ఆసుపత్రి|ఆస్పత్రి|క్లినిక్|மருத்துவமனை|ಆಸ್ಪತ್ರೆ|ആശുപത്രി|হাসপাতাল", "hospitals-and-clinics", "clinic", "SERVICE_PROVIDER"),
    (r"होटल|रेस्टोरेंट|ढाबा|भोजनालय|मेस|హోటల్|రెస్టారెంట్|భోజన|మెస్|உணவகம்|ஹோட்டல்|ಹೋಟೆಲ್|ഹോട്ടൽ|হোটেল|રેસ્ટોરન્ટ", "restaurants-and-food", "restaurant", "FOOD_SERVICE"),
    (r"बेकरी|मिठाई|स्वीट्स|బేకరీ|స్వీట్|మిఠాయి|பேக்கரி|ಬೇಕರಿ|ബേക്കറി|মিষ্টি", "bakeries-and-sweets", "sweets", "FOOD_SERVICE"),
    (r"किराना|जनरल स्टोर|परचून|राशन|కిరాణా|జనరల్ స్టోర్|மளிகை|ಕಿರಾಣಿ|പലചരക്ക്|মুদি", "grocery-and-kirana", "kirana-store", "RETAIL_STORE"),
    (r"कपड़ा|वस्त्र|साड़ी|रेडीमेड|బట్టల|వస్త్ర|చీరల|துணி|ಬಟ್ಟೆ|തുണി|কাপড়", "clothing-stores", "clothing-store", "RETAIL_STORE"),
    (r"ज्वेलर्स|ज्वैलर्स|सोनार|జ్యువెల్లర్|నగల|ஜவுளி|ನಗ|ജ്വല്ലറി|গহনা", "jewellery-stores", "jewellery-store", "RETAIL_STORE"),
    (r"हार्डवेयर|लोहा|सीमेंट|హార్డ్‌వేర్|ఇనుము|சிமெண்ட்|ಹಾರ್ಡ್‌ವೇರ್", "hardware-stores", "hardware-store", "RETAIL_STORE"),
    (r"इलेक्ट्रॉनिक|इलेक्ट्रिक|ఎలక్ట్రిక్|ఎలక్ట్రానిక్|மின்|ಎಲೆಕ್ಟ್ರಿಕ್", "electronics-stores", "electronics-store", "RETAIL_STORE"),
    (r"मोबाइल|మొబైల్|மொபைல்|ಮೊಬೈಲ್|മൊബൈൽ|মোবাইল", "mobile-stores", "mobile-phone-store", "RETAIL_STORE"),
    (r"फर्नीचर|ఫర్నిచర్|மரச்சாமான்|ಪೀಠೋಪಕರಣ|ഫർണിച്ചർ", "furniture-stores", "furniture-store", "RETAIL_STORE"),
    (r"सैलून|ब्यूटी|पार्लर|సెలూన్|బ్యూటీ|పార్లర్|அழகு|ಸಲೂನ್|ബ്യൂട്ടി", "salons-and-spas", "salon", "SERVICE_PROVIDER"),
    (r"दर्जी|टेलर|సైదర్|టైలర్|தையல்|ಟೈಲರ್|തയ്യൽ|দর্জি", "tailoring-and-boutiques", "tailor", "SERVICE_PROVIDER"),
    (r"गैरेज|मोटर्स|वर्कशॉप|గ్యారేజ్|మోటార్స్|ಗ್ಯಾರೇಜ್", "car-repair", "car-service", "SERVICE_PROVIDER"),
    (r"विद्यालय|पाठशाला|स्कूल|పాఠశాల|విద్యాలయ|స్కూల్|பள்ளி|ಶಾಲೆ|സ്കൂൾ|বিদ্যালয়", "schools", "school", "INSTITUTION"),
    (r"मंडप|टेंट|शादी|కళ్యాణ|టెంట్|మండప|மண்டப|ಮಂಟಪ", "event-services", "tent-house", "SERVICE_PROVIDER"),
    (r"पेट्रोल पंप|पेट्रोल|పెట్రోల్|பெட்ரோல்|ಪೆಟ್ರೋಲ್", "petrol-stations", "petrol-station", "RETAIL_STORE"),
]

# Name corrections, in order; a later match overrides an earlier one where the category differs.
NAME_RULES = [
    (r"\b(tent house|tent works|tents? (and|&) )", "event-services", "tent-house", "SERVICE_PROVIDER"),
    (r"\b(decorat(ors?|ion)|mandap|shamiana)\b", "event-services", "decorators", "SERVICE_PROVIDER"),
    (r"\b(function hall|kalyana ?mandap|convention)\b", "event-services", "function-hall", "HOSPITALITY"),
    (r"\b(xerox|photostat)\b", "printing-and-stationery", "photocopy", "SERVICE_PROVIDER"),
    (r"\b(tiffin ?cent|mess)\b", "restaurants-and-food", "tiffin-centre", "FOOD_SERVICE"),
    (r"\b(kirana|provision ?stores?)\b", "grocery-and-kirana", "kirana-store", "RETAIL_STORE"),
    (r"\b(pan ?shop|paan ?shop)\b", "grocery-and-kirana", "pan-shop", "RETAIL_STORE"),
]

# Names of public utilities, and names that are only a category word.
UTILITY_NAME = r"\b(state bank|sbi|hdfc bank|icici bank|axis bank|canara bank|union bank|bank of (baroda|india|maharashtra)|punjab national|indian bank|central bank of india|uco bank|idbi|kotak mahindra bank|post ?office|atm)\b"
GENERIC_NAME = r"^(medical|medicals|hotel|restaurant|general ?store|kirana|shop|store|bakery|salon|clinic|hospital|school|pharmacy|super ?market|hardware|electricals?|mobiles?)$"

# Hints in names, first match wins.
NAME_HINTS = [
    (r"\b(medical|medicals|pharmac\w*|chemist|drug ?house|druggist)\b", "medical-stores-and-pharmacies"),
    (r"\b(hospital|clinic|nursing home|diagnostic|scan cent|polyclinic|dental)\b", "hospitals-and-clinics"),
    (r"\b(bakery|bakers|cake ?shop|sweets?|mithai|confection\w*)\b", "bakeries-and-sweets"),
    (r"\b(restaurant|hotel ?&? ?restaurant|dhaba|biryani|tiffin|mess|cafe|caf[eé]|food ?court|canteen)\b", "restaurants-and-food"),
    (r"\b(kirana|general ?stores?|provision|super ?market|supermarket|grocery|grocers)\b", "grocery-and-kirana"),
    (r"\b(hardware|sanitary|plywood|building ?material|cement|paints?)\b", "hardware-stores"),
    (r"\b(electric\w*|electrical\w*)\b", "electrical-stores"),
    (r"\b(electronics|home appliance|appliances)\b", "electronics-stores"),
    (r"\b(mobiles?|mobile ?shop|cell ?point|smart ?phone)\b", "mobile-stores"),
    (r"\b(computers?|laptops?|systems? ?point)\b", "computer-and-laptop-stores"),
    (r"\b(furniture|furnitures|sofa|mattress)\b", "furniture-stores"),
    (r"\b(cloth\w*|garments?|textiles?|sarees?|boutique|fashions?|readymade)\b", "clothing-stores"),
    (r"\b(footwear|shoes?|chappal)\b", "footwear-stores"),
    (r"\b(jewell?ers?|jewell?ery|gold ?smith|silvers?)\b", "jewellery-stores"),
    (r"\b(salon|saloon|beauty ?parlou?r|hair ?(cut|dress)\w*|spa)\b", "salons-and-spas"),
    (r"\b(gym|fitness|yoga)\b", "beauty-and-wellness"),
    (r"\b(petrol ?(pump|bunk)|filling ?station|fuel ?station|hp ?petrol|bharat ?petroleum)\b", "petrol-stations"),
    (r"\b(tyres?|tyre ?works|battery|batteries)\b", "tyre-and-battery-stores"),
    (r"\b(auto ?(mobiles?|works)|motors?|garage|servicing ?cent|denting|painting ?works)\b", "car-repair"),
    (r"\b(school|vidyalaya|vidhyalaya|pathshala|convent)\b", "schools"),
    (r"\b(college|university|institute of|polytechnic|junior ?college)\b", "colleges"),
    (r"\b(coaching|tuitions?|academy|classes|study ?cent)\b", "tuition-and-coaching"),
    (r"\b(tailors?|tailoring|stitching|darzi)\b", "tailoring-and-boutiques"),
    (r"\b(xerox|photo ?copy|printers?|printing|stationery|book ?(shop|stall|store))\b", "printing-and-stationery"),
    (r"\b(courier|cargo|packers|movers|logistics|parcel)\b", "courier-and-parcel-services"),
    (r"\b(travels?|tours ?(and|&) ?travels?|tour ?operator)\b", "travel-services"),
    (r"\b(real ?estate|properties|realtors?|builders?|constructions?|infra\w*)\b", "property-services"),
    (r"\b(agencies|enterprises?|traders?|trading|distributors?|suppliers?|marketing)\b", "wholesale-businesses"),
    (r"\b(industries|engineering ?works|fabrications?|manufacturers?|mills?)\b", "local-manufacturers"),
    (r"\b(pet ?(shop|store|clinic)|aquarium|veterinary)\b", "pet-stores-and-pet-services"),
    (r"\b(nursery|seeds?|fertili[sz]ers?|agro|agri\w*)\b", "agricultural-supplies"),
    (r"\b(studio|photograph\w*|digital ?studio)\b", "event-services"),
    (r"\b(consultan\w*|associates|advocates?|chartered ?account\w*|law ?firm)\b", "professional-services"),
]

# Parts of names and addresses of sources that may never be used.
DENYLIST = (
    "google.com", "maps.google", "business.google", "googleapis.com/maps", "justdial", "indiamart", "facebook", "instagram", "linkedin", "sulekha", "zomato", "swiggy", "magicbricks", "99acres", "housing.com", "nobroker",
    "tripadvisor", "yelp",
)

# Words by which a name already says what the place is.
CATEGORY_WORD = (
    r"(medical|pharmac|chemist|clinic|hospital|dental|lab|hotel|restaurant|cafe|bakery|sweet|tiffin|mess|dhaba|kirana|super ?market|store|stores|mart|bazaar|traders?|agencies|hardware|electric|electronic|mobile|computer|furniture|"
    r"cloth|textile|saree|jewell?er|salon|beauty|spa|gym|motors?|automobile|garage|tyres?|petrol|school|college|academy|institute|coaching|tuition|bank|finance|insurance|consult|solutions?|enterprises?|industries|travels?|tours?|courier|"
    r"cargo|studio|photo|press|printers?|stationer|books?|builders?|properties|realtors?|estates?|pet|vet|nursery|seeds?|agro|tailors?|boutique|charging)"
)

# Outreach priorities of categories.
TIER1 = ("hardware-stores", "electrical-stores", "furniture-stores", "mobile-stores", "computer-and-laptop-stores", "pet-stores-and-pet-services", "grocery-and-kirana", "bakeries-and-sweets", "gift-stores", "tailoring-and-boutiques", "electronics-stores", "medical-stores-and-pharmacies")
TIER2 = ("plumbing-services", "electrical-services", "repair-services", "home-services", "cleaning-services", "salons-and-spas", "beauty-and-wellness", "tuition-and-coaching", "courier-and-parcel-services", "car-repair", "bike-repair")

# Ranks of place kinds for centroid matches (absent kinds rank 0).
# What a category is called behind a name that doesn't tell.
LABELS = {
    "medical-stores-and-pharmacies": "Medical Store", "hospitals-and-clinics": "Clinic", "restaurants-and-food": "Restaurant", "bakeries-and-sweets": "Bakery", "hotels-and-accommodation": "Hotel",
    "grocery-and-kirana": "Kirana Store", "hardware-stores": "Hardware Store", "electrical-stores": "Electrical Store", "electronics-stores": "Electronics Store", "mobile-stores": "Mobile Store",
    "computer-and-laptop-stores": "Computer Store", "furniture-stores": "Furniture Store", "clothing-stores": "Clothing Store", "footwear-stores": "Footwear Store", "jewellery-stores": "Jewellery Store",
    "beauty-and-wellness": "Beauty & Wellness", "salons-and-spas": "Salon", "automobile-services": "Automobile Services", "bike-repair": "Bike Repair", "car-repair": "Car Repair",
    "tyre-and-battery-stores": "Tyre & Battery", "petrol-stations": "Petrol Station", "ev-charging-stations": "EV Charging", "schools": "School", "colleges": "College",
    "tuition-and-coaching": "Coaching Centre", "education-and-training": "Training Centre", "repair-services": "Repair Service", "home-services": "Home Service", "plumbing-services": "Plumbing",
    "electrical-services": "Electrician", "cleaning-services": "Cleaning Service", "tailoring-and-boutiques": "Tailor", "home-businesses": "Home Business", "home-food-sellers": "Home Food",
    "pet-stores-and-pet-services": "Pet Store", "printing-and-stationery": "Printing & Stationery", "gift-stores": "Gift Store", "travel-services": "Travel Services",
    "courier-and-parcel-services": "Courier", "property-services": "Property Services", "professional-services": "Professional Services", "event-services": "Event Services",
    "agricultural-supplies": "Agri Supplies", "wholesale-businesses": "Wholesaler", "local-manufacturers": "Manufacturer", "other-local-businesses": "Local Business",
}
KIND_RANK = {"city": 6, "town": 5, "municipality": 5, "suburb": 4, "village": 3, "neighbourhood": 2, "quarter": 2, "hamlet": 1, "locality": 1}

# Column names that hold personal data.
PERSONAL = r"(?i)employer|proprietor|owner_name|applicant|aadhaar|pan|mobile|email|repEmail|contact_person"

# The fields of an export, in order.
EXPORT_FIELDS = (
    "external_directory_id", "pincode", "pincode_confidence", "pincode_method", "display_name", "resolved_name", "slug", "business_type", "category", "subcategory", "description", "public_phone", "phone_line_type",
    "whatsapp_available", "public_email", "website", "address_line_1", "address_line_2", "locality", "mandal", "city", "district", "state", "country", "latitude", "longitude", "location_accuracy",
    "opening_hours", "source_type", "source_name", "source_record_id", "source_url", "licence_name", "attribution_text", "confidence_score", "completeness_score",
    "freshness_score", "tier", "claim_status", "verification_status", "publication_type", "products_disabled", "offers_disabled", "reviews_disabled", "owner_contact_unconfirmed", "last_seen_at",
)
