"""Code lists and scores of the road-accident tables, as published with the data.

Codes 0 and 00 and empty text mean "unknown" and become NULL; codes not listed stay as they are.
"""

UNKNOWN = ("0", "00", "")

# --- characteristics ---
LIGHT = {
    "1": "Plein jour", "2": "Crépuscule ou aube", "3": "Nuit sans éclairage public",
    "4": "Nuit avec éclairage public non allumé", "5": "Nuit avec éclairage public allumé",
}
BUILT_UP = {"1": "Hors agglomération", "2": "En agglomération"}
CROSSING = {
    "1": "Hors intersection", "2": "Intersection en X", "3": "Intersection en T", "4": "Intersection en Y",
    "5": "Intersection à plus de 4 branches", "6": "Giratoire", "7": "Place", "8": "Passage à niveau",
    "9": "Autre intersection",
}
WEATHER = {
    "1": "Normale", "2": "Pluie légère", "3": "Pluie forte", "4": "Neige - grêle", "5": "Brouillard - fumée",
    "6": "Vent fort - tempête", "7": "Temps éblouissant", "8": "Temps couvert", "9": "Autre",
}
COLLISION = {
    "1": "Deux véhicules - frontale", "2": "Deux véhicules – par l’arrière", "3": "Deux véhicules – par le coté",
    "4": "Trois véhicules et plus – en chaîne", "5": "Trois véhicules et plus - collisions multiples",
    "6": "Autre collision", "7": "Sans collision",
}
TERRITORY = {
    "M": "Métropole", "A": "Antilles (Martinique ou Guadeloupe)", "G": "Guyane", "R": "Réunion", "Y": "Mayotte",
    "S": "St Pierre et Miquelon", "P": "Polynésie française", "W": "Wallis et Futuna", "C": "Nouvelle Calédonie",
    "T": "Terres austr. et antarct. Françaises",
}
CHARACTERISTICS = {
    "lum": LIGHT, "agg": BUILT_UP, "int": CROSSING, "atm": WEATHER, "col": COLLISION, "gps": TERRITORY,
}

# --- places ---
PLACES = {
    "catr": {
        "1": "Autoroute", "2": "Route Nationale", "3": "Route Départementale", "4": "Voie Communale",
        "5": "Hors réseau public", "6": "Parc de stationnement ouvert à la circulation publique", "9": "Autre",
    },
    "circ": {
        "1": "A sens unique", "2": "Bidirectionnelle", "3": "A chaussées séparées",
        "4": "Avec voies d’affectation variable",
    },
    "vosp": {"1": "Piste cyclable", "2": "Banque cyclable", "3": "Voie réservée"},
    "prof": {"1": "Plat", "2": "Pente", "3": "Sommet de côte", "4": "Bas de côte"},
    "plan": {"1": "Partie rectiligne", "2": "En courbe à gauche", "3": "En courbe à droite", "4": "En « S »"},
    "surf": {
        "1": "normale", "2": "mouillée", "3": "flaques", "4": "inondée", "5": "enneigée", "6": "boue",
        "7": "verglacée", "8": "corps gras - huile", "9": "autre",
    },
    "infra": {
        "1": "Souterrain - tunnel", "2": "Pont - autopont", "3": "Bretelle d’échangeur ou de raccordement",
        "4": "Voie ferrée", "5": "Carrefour aménagé", "6": "Zone piétonne", "7": "Zone de péage",
    },
    "situ": {
        "1": "Sur chaussée", "2": "Sur bande d’arrêt d’urgence", "3": "Sur accotement", "4": "Sur trottoir",
        "5": "Sur piste cyclable",
    },
}

# --- vehicles ---
VEHICLES = {
    "senc": {
        "1": "PK ou PR ou numéro d’adresse postale croissant", "2": "PK ou PR ou numéro d’adresse postale décroissant",
    },
    "obsm": {
        "1": "Piéton", "2": "Véhicule", "4": "Véhicule sur rail", "5": "Animal domestique", "6": "Animal sauvage",
        "9": "Autre",
    },
    "choc": {
        "1": "Avant", "2": "Avant droit", "3": "Avant gauche", "4": "Arrière", "5": "Arrière droit",
        "6": "Arrière gauche", "7": "Côté droit", "8": "Côté gauche", "9": "Chocs multiples (tonneaux)",
    },
    "catv": {
        "01": "Bicyclette", "02": "Cyclomoteur <50cm3",
        "03": "Voiturette (Quadricycle à moteur carrossé) (anciennement voiturette ou tricycle à moteur)",
        "04": "Référence plus utilisée depuis 2006 (scooter immatriculé)",
        "05": "Référence plus utilisée depuis 2006 (motocyclette)",
        "06": "Référence plus utilisée depuis 2006 (side-car)", "07": "VL seul",
        "08": "Catégorie plus utilisée (VL + caravane)", "09": "Catégorie plus utilisée (VL + remorque)",
        "10": "VU seul 1,5T <= PTAC <= 3,5T avec ou sans remorque (anciennement VU seul 1,5T <= PTAC <= 3,5T)",
        "11": "Référence plus utilisée depuis 2006 (VU (10) + caravane)",
        "12": "Référence plus utilisée depuis 2006 (VU (10) + remorque)", "13": "PL seul 3,5T <PTCA <= 7,5T",
        "14": "PL seul > 7,5T", "15": "PL > 3,5T + remorque", "16": "Tracteur routier seul",
        "17": "Tracteur routier + semi-remorque", "18": "Référence plus utilisée depuis 2006 (transport en commun)",
        "19": "Référence plus utilisée depuis 2006 (tramway)", "20": "Engin spécial", "21": "Tracteur agricole",
        "30": "Scooter < 50 cm3", "31": "Motocyclette > 50 cm et <= 125 cm", "32": "Scooter > 50 cm et <= 125 cm",
        "33": "Motocyclette > 125 cm", "34": "Scooter > 125 cm",
        "35": "Quad léger <= 50 cm (Quadricycle à moteur non carrossé)",
        "36": "Quad lourd > 50 cm (Quadricycle à moteur non carrossé)", "37": "Autobus", "38": "Autocar", "39": "Train",
        "40": "Tramway", "99": "Autre véhicule",
    },
    "obs": {
        "01": "Véhicule en stationnement", "02": "Arbre", "03": "Glissière métallique", "04": "Glissière béton",
        "05": "Autre glissière", "06": "Bâtiment, mur, pile de pont",
        "07": "Support de signalisation verticale ou poste d’appel d’urgence", "08": "Poteau", "09": "Mobilier urbain",
        "10": "Parapet", "11": "Ilot, refuge, borne haute", "12": "Bordure de trottoir",
        "13": "Fossé, talus, paroi rocheuse", "14": "Autre obstacle fixe sur chaussée",
        "15": "Autre obstacle fixe sur trottoir ou accotement", "16": "Sortie de chaussée sans obstacle",
    },
    "manv": {
        "01": "Sans changement de direction", "02": "Même sens, même file", "03": "Entre 2 files",
        "04": "En marche arrière", "05": "A contresens", "06": "En franchissant le terre-plein central",
        "07": "Dans le couloir bus, dans le même sens", "08": "Dans le couloir bus, dans le sens inverse",
        "09": "En s’insérant", "10": "En faisant demi-tour sur la chaussée", "11": "Changeant de file à gauche",
        "12": "Changeant de file à droite", "13": "Déporté à gauche", "14": "Déporté à droite", "15": "Tournant à gauche",
        "16": "Tournant à droite", "17": "Dépassant à gauche", "18": "Dépassant à droite", "19": "Traversant la chaussée",
        "20": "Manœuvre de stationnement", "21": "Manœuvre d’évitement", "22": "Ouverture de porte",
        "23": "Arrêté (hors stationnement)", "24": "En stationnement (avec occupants)",
    },
}

# --- users ---
SEVERITY = {"1": "Indemne", "2": "Tué", "3": "Blessé hospitalisé", "4": "Blessé léger"}
USERS = {
    "catu": {"1": "Conducteur", "2": "Passager", "3": "Piéton", "4": "Piéton en roller ou en trottinette"},
    "grav": SEVERITY,
    "sexe": {"1": "Masculin", "2": "Féminin"},
    "trajet": {
        "1": "Domicile – travail", "2": "Domicile – école", "3": "Courses – achats",
        "4": "Utilisation professionnelle", "5": "Promenade – loisirs", "9": "Autre",
    },
    "locp": {
        "1": "Sur chaussée à + 50 m du passage piéton", "2": "Sur chaussée à – 50 m du passage piéton",
        "3": "Sur passage piéton sans signalisation lumineuse", "4": "Sur passage piéton avec signalisation lumineuse",
        "5": "Sur trottoir", "6": "Sur accotement", "7": "Sur refuge ou BAU", "8": "Sur contre allée",
    },
    "actp": {
        "1": "Sens véhicule heurtant", "2": "Sens inverse du véhicule", "3": "Traversant", "4": "Masqué",
        "5": "Jouant – courant", "6": "Avec animal", "9": "Autre",
    },
    "etatp": {"1": "Seul", "2": "Accompagné", "3": "En groupe"},
    "secup": {
        "1": "Ceinture", "2": "Casque", "3": "Dispositif enfants", "4": "Equipement réfléchissant", "9": "Autre",
    },
    "secuu": {"1": "Oui", "2": "Non", "3": "Non déterminable"},
}

# --- ordinal scores ---
SEVERITY_SCORE = {"Indemne": 0, "Blessé léger": 10, "Blessé hospitalisé": 50, "Tué": 200}
BUILT_UP_SCORE = {"Hors agglomération": -100, "En agglomération": 100}
LIGHT_SCORE = {
    "Plein jour": 100, "Crépuscule ou aube": 50, "Nuit avec éclairage public allumé": 20,
    "Nuit avec éclairage public non allumé": 5, "Nuit sans éclairage public": 0,
}
WEATHER_SCORE = {
    "Normale": 100, "Pluie légère": 10, "Pluie forte": -90, "Neige - grêle": -100, "Brouillard - fumée": -10,
    "Vent fort - tempête": -50, "Temps éblouissant": 50, "Temps couvert": 8, "Autre": 0, "(Inconnu)": 0,
}
CROSSING_SCORE = {"(Inconnu)": 0, "Other": 0, "Hors Intersection": -100, "Avec Intersection": 100}
COLLISION_SCORE = {"(Inconnu)": 0, "Other": 0, "Avec collision": -100, "Sans collision": 100}
