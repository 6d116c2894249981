"""Word tables shipped as defaults. Each is an input: pass your own mapping or DataFrame instead."""

from __future__ import annotations

# English stop words.
STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves
he him his himself she she's her hers herself it it's its itself they them their theirs themselves
what which who whom this that that'll these those am is are was were be been being have has had
having do does did doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in out on off over
under again further then once here there when where why how all any both each few more most other
some such no nor not only own same so than too very s t can will just don don't should should've
now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn
hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn
shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# Valence added per degree word, from the published rule-based scoring model.
BOOST = 0.293
BOOSTERS = {
    word: BOOST
    for word in """
absolutely amazingly awfully completely considerable considerably decidedly deeply effing enormous
enormously entirely especially exceptional exceptionally extreme extremely fabulously flipping
flippin frackin fracking fricking frickin frigging friggin fully fuckin fucking fuggin fugging
greatly hella highly hugely incredible incredibly intensely major majorly more most particularly
purely quite really remarkably so substantially thoroughly total totally tremendous tremendously
uber unbelievably unusually utter utterly very
""".split()
} | {
    word: -BOOST
    for word in """
almost barely hardly kinda kindof less little marginal marginally occasional occasionally partly
scarce scarcely slight slightly somewhat sorta sortof
""".split()
}

# Words that flip the score of what follows, as spelled after normalising.
NEGATORS = """
aint arent cannot cant couldnt darent didnt doesnt dont hadnt hasnt havent isnt mightnt mustnt
neither neednt never none nope nor not nothing nowhere oughtnt shant shouldnt uhuh wasnt werent
without wont wouldnt rarely seldom despite
""".split()

# Phrases with a valence of their own, of those that outlive cleaning.
PHRASES = {"bad ass": 1.5, "broken heart": -2.9, "bus stop": 0.0, "yeah right": -2.0}

# Valences of common words on the usual -4..4 scale, as the published lexicon of the
# rule-based model gives them, for a small choice of its words.
LEXICON = {
    "love": 3.2, "great": 3.1, "best": 3.2, "excellent": 2.7, "awesome": 3.1, "amazing": 2.8,
    "good": 1.9, "nice": 1.8, "happy": 2.7, "beautiful": 2.9, "perfect": 2.7, "wonderful": 2.7,
    "fantastic": 2.6, "brilliant": 2.8, "win": 2.8, "winner": 2.8, "success": 2.7, "enjoy": 2.2,
    "fun": 2.3, "funny": 1.9, "glad": 2.0, "hope": 1.9, "kind": 2.4, "friend": 2.2, "like": 1.5,
    "lucky": 1.8, "proud": 2.1, "safe": 1.9, "smart": 1.7, "smile": 1.5, "strong": 2.3,
    "support": 1.7, "sweet": 2.0, "thank": 1.5, "thanks": 1.9, "true": 1.8, "trust": 2.3,
    "welcome": 2.0, "well": 1.1, "wow": 2.8, "yes": 1.7, "cool": 1.3, "easy": 1.9, "better": 1.9,
    "clean": 1.7, "clever": 2.0, "comfort": 1.5, "calm": 1.3, "care": 2.2, "agree": 1.5,
    "accept": 1.6, "admire": 2.1, "advantage": 1.0, "benefit": 2.0, "bless": 1.8, "brave": 2.4,
    "bright": 1.9, "celebrate": 2.7, "cheer": 2.3, "creative": 1.9, "cute": 2.0, "delight": 2.9,
    "eager": 1.5, "elegant": 2.1, "energetic": 1.9, "excite": 2.1, "fair": 1.3, "faith": 1.8,
    "famous": 2.2, "favorite": 2.0, "fine": 0.8, "free": 2.3, "fresh": 1.3, "gain": 2.4,
    "generous": 2.3, "gentle": 1.9, "gift": 1.9, "grace": 1.8, "help": 1.7, "honest": 2.3,
    "honor": 2.2, "humor": 1.1, "important": 0.8, "impress": 1.9, "improve": 1.9, "inspire": 2.7,
    "interest": 2.0, "joy": 2.8, "laugh": 2.6, "legal": 0.5, "peace": 2.5, "please": 1.3,
    "positive": 2.6, "pretty": 2.2, "reward": 2.7, "rich": 2.6, "romantic": 1.7, "worth": 0.9,
    "bad": -2.5, "worst": -3.1, "worse": -2.1, "terrible": -2.1, "horrible": -2.5, "awful": -2.0,
    "hate": -2.7, "sad": -2.1, "angry": -2.3, "annoy": -1.9, "ugly": -2.3, "stupid": -2.4,
    "wrong": -2.1, "fail": -2.5, "failure": -2.3, "lose": -1.7, "loss": -1.3, "lost": -1.3,
    "pain": -2.3, "problem": -1.7, "poor": -2.1, "war": -2.9, "kill": -3.7, "dead": -3.3,
    "death": -2.9, "die": -2.9, "fear": -2.2, "afraid": -1.5, "alone": -1.0, "anger": -2.7,
    "ashamed": -2.1, "attack": -2.1, "avoid": -1.2, "ban": -2.6, "blame": -1.4, "bore": -1.0,
    "break": -0.9, "broken": -2.1, "cheat": -2.0, "complain": -1.5, "confuse": -0.9, "crash": -1.7,
    "crazy": -1.4, "crime": -2.5, "cruel": -2.8, "cry": -2.1, "damage": -2.2, "danger": -2.4,
    "defeat": -2.0, "deny": -1.4, "destroy": -2.5, "difficult": -1.5, "dirty": -1.9,
    "disappoint": -1.7, "disaster": -3.1, "disgust": -2.9, "doubt": -1.5, "dumb": -2.3,
    "enemy": -2.5, "evil": -3.4, "fake": -2.1, "fault": -1.7, "fight": -1.6, "fire": -1.4,
    "fool": -1.9, "guilty": -1.8, "harm": -2.5, "hell": -3.6, "hurt": -2.4, "ignore": -1.5,
    "ill": -1.8, "insult": -2.3, "jealous": -2.0, "lazy": -1.5, "liar": -2.3, "lie": -1.6,
    "mad": -2.2, "mess": -1.5, "mistake": -1.4, "murder": -3.7, "nasty": -2.6, "no": -1.2,
    "panic": -2.3, "reject": -1.7, "risk": -1.1, "rude": -2.0, "scare": -2.2, "shame": -2.1,
    "sick": -2.3, "sorry": -0.3, "steal": -2.2, "stress": -1.8, "suffer": -2.5, "threat": -2.4,
    "trouble": -1.7, "unhappy": -1.8, "victim": -1.1, "violent": -2.9, "warn": -0.4, "weak": -1.9,
    "weird": -0.7, "worry": -1.9,
}

# Irregular English forms and their lemmas: one "lemma: forms" entry per word.
LEMMA_FORMS = """
be: am is are was were been being
have: has had having
do: does did done doing
go: goes went gone going
say: says said saying
get: gets got gotten getting
make: makes made making
know: knows knew known
think: thinks thought thinking
take: takes took taken taking
see: sees saw seen seeing
come: comes came coming
give: gives gave given giving
find: finds found finding
tell: tells told telling
feel: feels felt feeling
leave: leaves left leaving
keep: keeps kept keeping
begin: begins began begun
bring: brings brought
write: writes wrote written writing
sit: sits sat sitting
lose: loses lost losing
pay: pays paid paying
meet: meets met meeting
run: runs ran running
buy: buys bought buying
speak: speaks spoke spoken
read: reads reading
win: wins won winning
love: loves loved loving
hate: hates hated hating
like: likes liked liking
use: uses used using
post: posts posted posting
comment: comments commented commenting
man: men
woman: women
child: children
person: people
foot: feet
tooth: teeth
mouse: mice
good: better best
bad: worse worst
"""
LEMMAS = {
    form: line.split(":")[0]
    for line in LEMMA_FORMS.strip().splitlines()
    for form in line.split(":")[1].split()
}

# Part-of-speech tags of common words; a word not listed is taken for a noun.
DEFAULT_TAG = "NN"
TAG_WORDS = """
DT: the a an this that these those
IN: of in to for with on at by from as into about after before over under between
CC: and or but nor
PRP: i you he she it we they me him her us them
MD: can could will would shall should may might must
VB: be have do go say get make know think take see come give find tell feel leave keep write read
RB: not very really never always often also just only even here there now then too well
JJ: good bad new old big small great long little own other high low young large early late same
JJ: free real hot cold full clear easy hard strong weak happy sad nice fine public private whole
"""
TAGS = {
    word: line.split(":")[0]
    for line in TAG_WORDS.strip().splitlines()
    for word in line.split(":")[1].split()
}
