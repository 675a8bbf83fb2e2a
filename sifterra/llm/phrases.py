"""Public wordings of error pages, script notices, filler and furniture in several languages. Lower case, straight quotes, digits as 0."""

# Phrases that name an error, a refusal of access or a missing page, one a line.
ERROR_PHRASES = """
error 0
0 error
http error
http 0
status code 0
status: 0
error code
error id
not found
nothing found
nothing under this address
nothing here
could not be found
couldn't be found
cannot be found
can't be found
can't find
cannot find
could not find
no longer exists
no longer available
not available
does not exist
doesn't exist
has been deleted
page has moved
page has been moved
page was moved
forbidden
access denied
access to this
permission denied
you do not have permission
you don't have permission
do not have access
not authorized
not authorised
unauthorized
not allowed
bad request
bad gateway
gateway timeout
gateway time-out
timed out
request blocked
you have been blocked
too many requests
rate limit
server error
server is busy
service unavailable
temporarily unavailable
temporarily down
currently unavailable
unavailable
site is down
is offline
under maintenance
down for maintenance
scheduled maintenance
being repaired
out of service
went wrong
just broke
error occurred
error has occurred
unexpected error
unknown error
fatal error
parse error
uncaught
exception in
unhandled exception
runtime error
stack trace
traceback
typeerror
nullpointer
undefined variable
segmentation fault
session has expired
session expired
has been suspended
account suspended
domain has expired
domain is for sale
buy this domain
domain parking
connection to the database
connect to the database
database connection
connection refused
connection reset
connection failed
failed to load
could not be loaded
cannot be displayed
can't be displayed
can't be reached
cannot be reached
index of
parent directory
broken link
invalid url
oops
whoops
फेला परेन
फेला पार्न सकिएन
भेटिएन
अस्तित्वमा छैन
सर्भरमा समस्या
सर्भर त्रुटि
त्रुटि भयो
त्रुटि 0
समस्या आयो
पहुँच अस्वीकृत
अनुमति छैन
सेवा उपलब्ध छैन
उपलब्ध छैन
मर्मत सम्भार
पुनः प्रयास
नहीं मिला
नहीं मिली
मौजूद नहीं
त्रुटि हुई
सर्वर में त्रुटि
पहुँच अस्वीकार
अनुमति नहीं
सेवा उपलब्ध नहीं
उपलब्ध नहीं
रखरखाव
पुनः प्रयास करें
nicht gefunden
existiert nicht
nicht vorhanden
nicht verfügbar
zugriff verweigert
keine berechtigung
serverfehler
fehler 0
ist ein fehler
wartungsarbeiten
zeitüberschreitung
sitzung ist abgelaufen
non trouvée
introuvable
n'existe pas
accès refusé
accès interdit
erreur 0
erreur interne
une erreur
indisponible
en maintenance
no encontrada
no se encontró
no se ha encontrado
no existe
acceso denegado
acceso prohibido
error interno
no disponible
en mantenimiento
non trovata
non esiste
accesso negato
errore 0
errore interno
não encontrada
não existe
acesso negado
erro 0
erro interno
niet gevonden
"""

# Phrases that ask for scripts or for patience.
SCRIPT_PHRASES = """
javascript
java script
script-capable
scripts are
scripts have been
scripts turned
support scripts
your browser
browser check
cookies must be
loading
please wait
wait a moment
one moment
just a moment
hang tight
are you a robot
you are human
you're human
verify you are
ddos protection
जाभास्क्रिप्ट
जावास्क्रिप्ट
लोड हुँदैछ
लोड हुँदै
पर्खनुहोस्
कृपया प्रतीक्षा
लोड हो रहा
प्रतीक्षा करें
wird geladen
bitte warten
einen moment
chargement
veuillez patienter
un instant
cargando
espere por favor
por favor espere
un momento
caricamento
attendere prego
carregando
aguarde
"""

# Filler that stands where a text should.
FILLER_PHRASES = """
your text here
your content here
text goes here
content goes here
add your text
click here to edit
click to edit
edit this text
replace this text
sample page
sample text
sample content
this is a sample
dummy text
placeholder text
your first entry
your first post
hello world
just another wordpress site
under construction
coming soon
stay tuned
no description
no content
no items to display
nothing to display
nothing to show
to be announced
asdf
qwerty
zxcv
test test
testing 0 0 0
xxx
foo bar
सामग्री चाँडै
चाँडै आउँदैछ
विवरण राख्नुहोस्
यहाँ लेख्नुहोस्
निर्माणाधीन
परीक्षण परीक्षण
जल्द आ रहा
निर्माणाधीन है
यहाँ लिखें
hier steht ihr text
ihr text hier
blindtext
demnächst
im aufbau
votre texte ici
bientôt disponible
en construction
su texto aquí
próximamente
testo di esempio
em breve
em construção
"""

# Phrases and shapes of unfilled template marks. Those that open a mark close with their partner.
MARK_PHRASES = """
undefined
nan
[object object]
{0}
"""
MARK_PAIRS = [("{{", "}}"), ("{%", "%}"), ("<%", "%>"), ("<?", "?>"), ("[[", "]]"), ("[%", "%]"), ("${", "}"), ("#{", "}"), ("%%", "%%"), ("__", "__"), ("[insert", "]"), ("[enter", "]"), ("[your", "]"), ("[add", "]"), ("[तपाईंको", "]"), ("[ihr", "]"), ("[name", "]"), ("[date", "]"), ("[title", "]")]
MARK_PREFIXES = ["@model."]

# Words that stand beside those phrases in a notice and say nothing of their own there.
NOTICE_WORDS = """
a about above available administrator address after again all an and another any app application apologies are as at back be been before begin below blank block broke browser busy but by came can cannot check checked checking choose click
code comments come connection contact content continue cookie cookies could correct deleted denied description did different directory disable disabled do does don't down due enable enabled end error errors exist expired few file files find first for found from
full get go got has hasn't have help here home homepage host hosting if in inconvenience instead is it its issue item items know later left let like line link load loaded log login look looking may might minute minutes mistyped moment more most
moved must my name need needs new no not nothing number object of off old on once one or order other our out outdated own page pages part parts path permission please portal possible private problem provider proxy reached reason refer reference refresh
reload removed renamed request requested require required requires resource resources restricted result results retry return run running screen search seconds see seem seems server service session should site size soon some something sorry start state stay still
stopped support supported switch switched take takes technical text that the their then there these thing this those time to tomorrow tonight top track trouble trying try turn turned type typed unable unfortunately until up upgrade url us use used user using
view viewing visit wait want was way we we're web webmaster website went were what when where which while will with won't working wrong you you're your
last modified php line main view portal render uploads
कृपया यो यस पृष्ठ हेर्न सक्रिय गर्नुहोस् माफ तपाईंले तपाईंको खोज्नुभएको केही समयपछि पछि प्रयास ब्राउजर ब्राउजरमा साइट चलाउन खोल्नुहोस् पुन फेरि नक्सा यहाँ सर्भर सर्भरमा लागि छ छैन हो गर्न सकिएन अहिले हाल
पेज में को के लिए आप आपके देखने चालू करें यह इस कृपया बाद समय ब्राउज़र सर्वर क्षमा है नहीं रहा
bitte aktivieren sie ihr ihren browser seite die der das den um zu diese dieser angeforderte angeforderten wurde konnte leider ist es aufgetreten anzuzeigen später erneut versuchen server interner dienst vorübergehend wegen auf ein eine haben keine für
page la le les de du des cette votre vous vous n'avez veuillez activer navigateur demandée demandé est a été n'a pu être trop tard réessayer serveur service temporairement pas pour une un il y avez s'est produite désolé
página pagina la el los de del en su por favor active activar navegador solicitada solicitado ha se una un que servidor servicio temporalmente para esta este lo sentimos producido
il lo gli di si prega attivare questa questo non è stata stato richiesta browser servizio temporaneamente
a o os da do das dos em seu sua ative habilite navegador solicitada não foi possível esta este
"""

# Words of the customary pseudo-Latin filler text.
FILLER_WORDS = """
lorem ipsum dolor sit amet consectetur consectetuer adipiscing adipisicing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat
duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum praesent vestibulum fermentum pharetra viverra porta nisl erat
justo congue dictum pellentesque habitant morbi tristique senectus netus malesuada fames ac turpis egestas mauris vitae ultricies leo integer vivamus suspendisse potenti aenean curabitur phasellus maecenas sollicitudin bibendum faucibus
"""
