"""Fixed values.

Everything in this module is a fixed value: word lists, labels, thresholds and
formats that results must agree on.  There is no logic here.  Every list is a
default; the functions that use one take it as a parameter.
"""

# --- Fixed values: the aspects and the columns they use ----------------------

ASPECTS = ("comida", "servicio", "precio", "ambiente")

ASPECT_LABELS = {
    "comida": "Comida",
    "servicio": "Servicio",
    "precio": "Precio",
    "ambiente": "Ambiente",
}

# aspect, sort order, description
ASPECT_DIM_ROWS = (
    ("Comida", 1, "Calidad, sabor y presentacion de los platos"),
    ("Servicio", 2, "Atencion del personal, rapidez y trato"),
    ("Precio", 3, "Relacion entre lo que se paga y lo que se recibe"),
    ("Ambiente", 4, "Local, decoracion, ruido y comodidad"),
)

LABEL_SCORES = {"positive": 1.0, "neutral": 0.0, "negative": -1.0}

# --- Fixed values: words that name an aspect ---------------------------------

FOOD_WORDS = """
comida comidas food plato platos platillo platillos dish dishes sabor sabores
sabroso menu menú cocina chef carne carnes pescado mariscos camarones pollo
ensalada sopa postre postres pasta pizza sushi hamburguesa arroz pan queso salsa
entrada entradas porcion porción porciones ingredientes fresco frescos cocinado
cocida punto sazon sazón desayuno almuerzo cena bebida bebidas cafe café coctel
cóctel trago vino cerveza delicioso deliciosa rico rica taste flavor meal dessert
starter portion cooked
""".split()

SERVICE_WORDS = """
servicio service atencion atención atendieron atendio atendió atendida atendido
mesero meseros mesera meseras camarero camarera mozo personal empleado empleados
staff waiter waitress trato amabilidad amable amables espera esperamos esperar
demora demoro demoró tardaron rapidez atento atenta atentos anfitrion anfitrión
reserva reservacion reservación pedido orden cortesia cortesía profesional hostess
bartender
""".split()

PRICE_WORDS = """
precio precios price prices pricing cost costo caro cara caros caras expensive
barato barata baratos cheap economico económico economica económica vale valen
worth dinero money bill cuenta pagar pague pagamos cobran cobro cobraron tarifa
factura value accesible asequible presupuesto afordable affordable promocion
promoción descuento oferta costoso costosa dolares dólares balboas
""".split()

AMBIENCE_WORDS = """
ambiente ambiance ambience atmosfera atmósfera atmosphere decoracion decoración
decoration decor lugar place espacio vista vistas view musica música music ruido
ruidoso noise noisy acogedor acogedora cozy iluminacion iluminación luz terraza
rooftop jardin jardín mesa mesas silla sillas local instalaciones bano baño banos
baños limpieza limpio limpia sucio sucia climatizado romantico romántico familiar
tranquilo tranquila concurrido lleno decorado moderno moderna elegante rustico
rústico
""".split()

# Phrases that name an aspect; each is anchored on its first word.
PRICE_PHRASES = ("relacion calidad", "relación calidad", "calidad precio")
AMBIENCE_PHRASES = ("aire acondicionado",)

# --- Fixed values: words with a polarity -------------------------------------

POSITIVE_WORDS = """
excelente excelentes delicioso deliciosa deliciosos deliciosas rico rica ricos ricas
riquisimo riquísimo buenisimo buenísimo bueno buena buenos buenas increible increíble
espectacular espectaculares recomendado recomendada recomiendo recomendable amable
amables atento atenta atentos atentas perfecto perfecta encanto encantó encanta
maravilloso maravillosa fresco fresca sabroso sabrosa agradable rapido rápido rapida
rápida generoso generosa bonito bonita lindo linda divino divina super súper genial
fabuloso exquisito exquisita mejor mejores favorito favorita calidad gusto gusta gustó
encantador encantadora wow top supero superó
acogedor acogedora cordial cordiales profesional eficiente eficientes puntual limpio
limpia impecable tranquilo tranquila comodo cómodo comoda cómoda elegante moderno
moderna romantico romántico hermoso hermosa abundante abundantes generosas jugoso
jugosa crujiente tierno tierna autentico auténtico casero casera economico económico
economica económica accesible asequible justo justa razonable razonables conveniente
volveria volvería volveremos repetire repetiré vale valio valió buenisima buenísima
sorprendio sorprendió sorprendente
excellent delicious great amazing good best friendly wonderful perfect awesome tasty
nice fantastic love loved recommend recommended fresh gorgeous polite balanced cozy
attentive affordable reasonable clean beautiful outstanding superb flavorful generous
welcoming charming solid worth
""".split()

NEGATIVE_WORDS = """
malo mala malos malas pesimo pésimo malisimo malísimo terrible feo fea lento lenta
lentos frio frío fria fría caro cara caros caras demora demoro demoró tardo tardó sucio
sucia grosero grosera descortes descortés decepcion decepción decepcionado decepcionada
decepcionante horrible mediocre desabrido salado quemado incomodo incómodo incomoda
incómoda ruidoso ruidosa falta faltan falto faltó peor peores regular asco defraudo
defraudó defrauda fome
elevado elevada elevados elevadas exagerado exagerada carisimo carísimo carisima
carísima sobrevalorado sobrevalorada costoso costosa abusivo abusiva escaso escasa
escasas pequena pequeña insuficiente tibio tibia seco seca duro dura insipido insípido
insipida insípida aguado aguada grasoso grasosa quemada crudo cruda descuidado
descuidada desatento desatenta antipatico antipático antipatica antipática tardaron
olvidaron olvido olvidó error errores equivocaron reclamo queja evitar eviten
lamentable penoso penosa desagradable estrecho estrecha apretado apretada desorganizado
bad awful slow cold expensive overpriced disappointing disappointed worst rude dirty
bland tasteless soggy burnt undercooked cramped noisy unfriendly pricey avoid waited
forgot wrong
""".split()

INTENSIFIER_WORDS = """
muy super súper bastante tan demasiado sumamente realmente totalmente completamente
extremadamente very really extremely so absolutely incredibly
""".split()

NEGATOR_WORDS = "no nunca sin tampoco ni jamas jamás nada".split()

# Letters of a word.  The dotless i and the long s belong to a-z when case is ignored.
WORD_LETTERS = "a-zıſáéíóúñü"

NEGATION_REACH = 3      # words before a polar word that may negate it
INTENSITY_REACH = 2     # words before a polar word that may intensify it
INTENSITY_FACTOR = 1.5
REACH_AFTER_MENTION = 6   # a polar word may follow its aspect by this many words
REACH_BEFORE_MENTION = 3  # ... or precede it by this many

# --- Fixed values: prices ----------------------------------------------------

PRICE_LABELS_BY_LEVEL = {
    1: ("hasta $15", "menos de $15", "$", "cheap eats"),
    2: ("desde $15 hasta $25", "$$", "$$ - $$$", "mid-range"),
    3: ("desde $25 hasta $35", "$$$", "$$$ - $$$$"),
    4: ("mas de $35", "más de $35", "$$$$", "fine dining"),
}

PRICE_BANDS = {
    1: "$ (hasta $15)",
    2: "$$ ($15-$25)",
    3: "$$$ ($25-$35)",
    4: "$$$$ (mas de $35)",
}

DEFAULT_PRICE_LEVEL = 2.0

# --- Fixed values: languages and stop words ----------------------------------

SPANISH_INDICATORS = "el la los las un una de del en que es por con para".split()
ENGLISH_INDICATORS = "the a an is was were are be have has had and or but".split()

MODEL_STOPWORDS = """
a al algo algunas algunos ante antes como con contra cual cuando de del desde donde
durante e el ella ellas ellos en entre era es esa ese eso esta estaba estan este esto
estos fue fueron ha habia han hasta hay la las le les lo los mas me mi mucho muy nos o
otra otro para pero poco por porque que se ser si sin sobre solo son su sus tambien te
tiene todo un una uno unos y ya
""".split()

# --- Fixed values: words dropped from an entity name, city names -------------

NAME_NOISE_PATTERN = r"\b(restaurante?|resto|bar|grill|cafe)\b"
CITY_NAMES = ("panama", "panamá", "ciudad de panama", "ciudad de panamá")

# --- Fixed values: class labels and thresholds -------------------------------

POSITIVE_CLASS = "positiva"
MINORITY_CLASS = "no positiva"
POSITIVE_FROM_RATING = 4

BUCKET_POSITIVE = "Positivo"
BUCKET_NEUTRAL = "Neutral"
BUCKET_NEGATIVE = "Negativo"
BUCKET_MISSING = "Sin datos"
BUCKET_EDGE = 0.1

LOW_RATING = 3.0
FAVOURABLE_SENTIMENT = 0.1

# --- Fixed values: names for clusters, in order of the profile metrics -------

CLUSTER_NAME_BY_METRIC = {
    "avg_rating": "Mejor calificados",
    "avg_price_level": "Alta gama",
    "avg_comida_sentiment": "Destacan por la comida",
    "avg_servicio_sentiment": "Destacan por el servicio",
    "avg_ambiente_sentiment": "Destacan por el ambiente",
    "avg_precio_sentiment": "Buena relacion precio",
    "review_count": "Los mas comentados",
}
LOW_PRICE_CLUSTER_NAME = "Economicos"

# --- Fixed values: translations for display ----------------------------------

VALUE_TRANSLATIONS = {
    "Panama City": "Ciudad de Panamá",
    "panama city": "Ciudad de Panamá",
    "General": "Variada",
    "Contemporanea": "Contemporánea",
    "Latinoamericana, Contemporanea, Panameña": "Latinoamericana, Contemporánea, Panameña",
    "restaurantguru": "RestaurantGuru",
    "degusta": "Degusta",
    "english": "Inglés",
    "spanish": "Español",
    "mixed": "Mixto",
    "en": "Inglés",
    "es": "Español",
    "positive": "positivo",
    "negative": "negativo",
    "neutral": "neutral",
}

COLUMN_LABELS = {
    "restaurant_id": "ID",
    "restaurant_name": "Restaurante",
    "category": "Categoría",
    "location": "Ubicación",
    "price_range": "Rango de precio",
    "overall_rating": "Calificación general",
    "food_rating": "Calificación de comida",
    "service_rating": "Calificación de servicio",
    "ambiance_rating": "Calificación de ambiente",
    "review_text": "Reseña",
    "review_date": "Fecha de reseña",
    "reviewer_name": "Autor",
    "source": "Fuente",
    "review_language": "Idioma",
    "word_count": "Cantidad de palabras",
    "char_count": "Cantidad de caracteres",
    "avg_word_length": "Longitud promedio de palabra",
    "cluster": "Grupo",
}

# Applied in this order; a later pair sees the result of the earlier ones.
PHRASE_REPLACEMENTS = (
    ("Meal type", "Tipo de comida"),
    ("Price per person", "Precio por persona"),
    ("Food", "Comida"),
    ("Service", "Servicio"),
    ("Atmosphere", "Ambiente"),
    ("Recommended dishes", "Platos recomendados"),
    ("Vegetarian options", "Opciones vegetarianas"),
    ("Dietary restrictions", "Restricciones alimentarias"),
    ("Dinner", "cena"),
    ("Lunch", "Almuerzo"),
    ("Other", "otro"),
    ("Good choice", "buena opción"),
    ("Good", "bueno"),
    ("pet friendly", "apto para mascotas"),
    ("Pet friendly", "Apto para mascotas"),
    ("slices", "porciones"),
    ("Slices", "Porciones"),
    ("slice", "porción"),
    ("Slice", "Porción"),
    ("rolls", "rollos"),
    ("Rolls", "Rollos"),
    ("lunch", "almuerzo"),
    ("brunch", "brunch"),
    ("deliveries", "entregas a domicilio"),
    ("full recomendado", "muy recomendado"),
    ("NY style", "estilo Nueva York"),
    ("NY stule", "estilo Nueva York"),
)

MONTH_NAMES = ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio",
               "agosto", "septiembre", "octubre", "noviembre", "diciembre")

# --- Fixed values: texts of notes and explanations ---------------------------

MORE_NAMES = " y %d mas"
QUALITY_NOTE = (
    "Aviso de calidad de datos: %d restaurante(s) tienen una calificacion que "
    "contradice el texto de sus resenas, por una inconsistencia en la fuente "
    "RestaurantGuru (%s). Su calificacion no es fiable y no se usa para rankings."
)
QUALITY_ADVICE = "Si te preguntan por el peor restaurante, menciona esta limitacion en lugar de dar por buena esa calificacion."
EXPLAIN_EXCELLENT = "Excelente calificación de %.1f/5.0"
EXPLAIN_GOOD = "Buena calificación de %.1f/5.0"
EXPLAIN_CATEGORY = "Categoría: %s"
EXPLAIN_ASPECT = "Muy buenas reseñas sobre %s"
EXPLAIN_DEFAULT = "Combina bien con tus preferencias"
