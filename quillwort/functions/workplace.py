"""The workplace type of a posting, told from labels, titles, places and texts.

Texts are read as a string of tags, one letter a word: a word's tag comes from a vocabulary, and rules are short
patterns over tags. Vocabulary and rules are data; both inferences below only differ in the rules they read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bound, normalize

REMOTE, HYBRID, ONSITE, UNKNOWN = "Remoto", "Híbrido", "Presencial", "Não informado"
ORDER = [REMOTE, HYBRID, ONSITE, UNKNOWN]

#: Phrases that are read as one word.
PHRASES = {"home office": "homeoffice", "on site": "onsite", "in loco": "inloco"}
#: Words by tag. Capitals are workplaces, small letters what stands around them; any other word is a point.
VOCABULARY = {
    "R": "remoto remota", "E": "remote remoteremote", "O": "homeoffice", "V": "remotamente remotely teletrabalho",
    "P": "presencial", "Q": "presencialmente", "S": "onsite onsiteonsite inloco", "p": "presenciais",
    "H": "hibrido hibrida", "X": "hybrid hybridhybrid",
    # What declares a workplace: models, places of work, kinds of contract, positions, hours.
    "m": "modelo", "d": "modalidade regime formato modo trabalho atuacao vaga", "L": "local", "F": "forma maneira",
    "C": "contrato contratacao", "c": "clt pj estagio estagiario trainee aprendiz temporario efetivo efetiva remunerado",
    "g": "jornada posicao oportunidade localizacao localidade cargo", "z": "horario turno escala", "D": "disponibilidade",
    "j": "internship job position role", "w": "work working", "n": "model", "W": "workplace", "f": "office escritorio", "1": "first",
    # Verbs of working, and words that link.
    "v": "trabalha trabalhe trabalhar trabalhando trabalhara", "y": "atuar estagiar atuara",
    "l": "de do da em no na a o as os para por com in the with entre", "e": "e ou", "b": "eh sera", "i": "totalmente fully full time",
    # Parts of a week.
    "u": "x dia dias vez vezes day days", "s": "semana semanais week", "k": "segunda terca quarta quinta sexta sabado sabados domingo domingos monday friday",
    "N": "1 2 3 4 um dois tres quatro", "5": "5 cinco", "x": "conforme", "A": "aberta",
    # Work that is done for others, technology, benefits and those who get them.
    "a": "acesso atendimento atender chamado chamados cliente clientes implantacao instalacao manutencao monitoramento suporte telefone"
    " treinamento treinamentos usuario usuarios assistencia",
    "t": "nuvem cloud ambiente ambientes arquitetura infraestrutura solucao solucoes aplicacao aplicacoes plataforma plataformas web mobile"
    " android ios search react native codigo",
    "B": "auxilio kit vale custo", "M": "maes mamaes pais papais",
}
#: Words that no list holds, by pattern: counts with their unit, hours, and a hundred per cent.
SHAPES = {"Y": "^[1-4]x$", "Z": "^5x$", "h": "^[1-9][0-9]?h(rs|oras)?$", "i": "^([a-z]*)100$"}
_MENTION = "remot|home ?office|teletrabalho|presencia|on ?site|in loco|hibrid|hybrid|in office"

# What may lie between a declaration and a workplace, what declares one, and a number of days, of the week perhaps.
_GAP, _DECLARES, _COUNT = "[^REOVPQSHX]", "[dmL](?:ld)?", "(?:[YZ]|[N5]u)"
_DAYS = f"{_COUNT}(?:ls)?"

#: A text of a posting that only speaks of work for others: both ways of giving support, or support at a distance.
OPERATIONAL = "a.{0,12}?(?:Pe?R|Re?P)|a.?R"
#: Home office as a benefit, or for parents.
BENEFITS = "Bl?O|OlM"
#: What tells a workplace in the title, and in the text; the first rule that holds decides.
TITLE = [(HYBRID, "H"), (REMOTE, "^[^PS]*[REOV][^PS]*$"), (ONSITE, "^[^REOV]*[PS][^REOV]*$")]
GENERAL = [(HYBRID, "H|up|Pe?R|Re?P"), (REMOTE, "[dmLF](?:ld)?R"), (ONSITE, "[dmLF](?:ld)?P"), *TITLE[1:]]
#: The same for sources that declare workplaces in a field, where a text must be explicit.
EXPLICIT = [
    (HYBRID, "wnX"), (REMOTE, "wnE"), (ONSITE, "wnS"),
    # Hybrid models, hybrid positions, and weeks that have days of both kinds.
    (HYBRID, f"Xwn|Xj|Xlf|f.{{0,3}}X|H{_COUNT}l*s|Hl[N5]up|El[N5]ul{{1,2}}f"),
    (HYBRID, f"[dm](?:ld)?(?:Pe{{1,2}}R|Re{{1,2}}P)|[dmgL]{_GAP}{{0,9}}H"),
    (HYBRID, f"{_DAYS}[Pp]{_GAP}{{0,6}}{_DAYS}l?O|{_DAYS}l?O{_GAP}{{0,2}}{_DAYS}l?[Pp]|P{_GAP}{{0,4}}k{_GAP}{{0,10}}kO"),
    # A declaration right before the workplace.
    (REMOTE, f"{_DECLARES}[RO]"), (ONSITE, f"{_DECLARES}P"),
    # The word for hybrid, unless it tells of technology.
    (HYBRID, "(?<!t.{0,3})[HX](?!l?t)"),
    # Work at a distance: all of it, as the model or the hours, by verbs of working, and in English.
    (REMOTE, f"i[REO]|{_DECLARES}(?:[eb]?i?O|cR)|g[eb]R|z{_GAP}{{0,14}}O|g{_GAP}{{0,14}}O|g{_GAP}{{0,8}}lFR|vV|yV{_GAP}{{0,9}}O|ylO|^O"),
    (REMOTE, f"E1|Ewn|WE|Ej|^c{_GAP}{{1,6}}E|wV"),
    # Work on site: all of it, as contract or hours, as the position, by availability, and in English.
    (ONSITE, "(?:i|C(?:ld)?c?|hs|ce?)P(?!e[RV])|wlfkk"),
    (ONSITE, f"(?:d[eb]|dly|dce|gi{{0,2}}|dA{_GAP}{{0,8}}|D{_GAP}{{0,12}}|z{_GAP}{{0,14}}|g{_GAP}{{0,14}}|[mL]ld{_GAP}{{0,12}})P(?!e[RV])"),
    (ONSITE, "[vy](?:lF|ld|i)?[PQ](?!x|e[RV]|Y|Nu)"),
]


def _tag(word: Column) -> Column:
    listed = [F.when(word.isin(*words.split()), F.lit(tag)) for tag, words in VOCABULARY.items()]
    shaped = [F.when(word.rlike(shape), F.lit(tag)) for tag, shape in SHAPES.items()]
    return F.coalesce(*listed, *shaped, F.lit("."))


def tags(text: Column) -> Column:
    """One letter for each word of a text; a text that mentions no workplace has none."""
    plain = normalize(text)
    joined = reduce(lambda x, pair: F.replace(x, F.lit(pair[0]), F.lit(pair[1])), PHRASES.items(), plain)
    return F.when(plain.rlike(_MENTION), F.array_join(F.transform(F.split(joined, " "), _tag), "")).otherwise("")


def first_rule(tagged: Column, rules: list[tuple[str, str]]) -> Column:
    """The workplace of the first rule whose pattern occurs in the tags, or null."""
    return bound(tagged, lambda t: F.coalesce(*[F.when(t.rlike(pattern), F.lit(found)) for found, pattern in rules]))


def normalize_workplace(raw: Column) -> Column:
    """The workplace type that a source's label stands for."""
    exact = {REMOTE: ["remote", "remoto", "home office"], HYBRID: ["hybrid", "hibrido"], ONSITE: ["on site", "onsite", "presencial"]}
    parts = [(REMOTE, "home office"), (REMOTE, "remoto"), (HYBRID, "hibrid"), (ONSITE, "presencial")]

    def told(plain: Column) -> Column:
        whole = [F.when(plain.isin(*labels), F.lit(found)) for found, labels in exact.items()]
        return F.coalesce(*whole, *[F.when(F.contains(plain, F.lit(part)), F.lit(found)) for found, part in parts], F.lit(UNKNOWN))

    return bound(normalize(raw), told)


def _by_place(location: Column) -> Column:
    """What a place says by itself: a place that is no country is where the work is done."""
    plain = normalize(location)
    said = normalize_workplace(location)
    near = F.contains(plain, F.lit("cidades proximas")) | F.contains(plain, F.lit("apenas candidaturas"))
    return F.when(said.isin(REMOTE, HYBRID), said).when(near, ONSITE).when(plain.isin("", "brasil", "brazil", "nacional"), UNKNOWN).otherwise(ONSITE)


def infer_workplace(explicit: Column, location: Column, title: Column, description: Column, trust_location: Column | bool = True) -> Column:
    """The workplace type by label, title, text and, where ``trust_location`` holds, location, in this order."""
    label, head = normalize_workplace(explicit), tags(title)
    text = F.concat(head, F.lit("."), F.regexp_replace(tags(description), OPERATIONAL, "."))
    trust = F.lit(trust_location) if isinstance(trust_location, bool) else trust_location
    return F.coalesce(F.when(label != UNKNOWN, label), first_rule(head, TITLE), first_rule(text, GENERAL), F.when(trust, _by_place(location)), F.lit(UNKNOWN))


def infer_declared(current: Column, declared: Column, location: Column, title: Column, description: Column) -> Column:
    """The workplace type of a posting whose source has a field for it.

    A declared value stands. Else the title tells it, then the location by name, and then the description if it is
    explicit: without the benefits it names, by the first rule of ``EXPLICIT`` that holds.
    """
    plain, said = normalize(location), normalize_workplace(location)
    named = said.isin(REMOTE, HYBRID) | ((said == ONSITE) & plain.rlike("presencial|on ?site"))
    text = F.regexp_replace(tags(description), BENEFITS, ".")
    return F.coalesce(
        F.when(F.coalesce(declared, F.lit(False)), normalize_workplace(current)), first_rule(tags(title), TITLE), F.when(named, said),
        first_rule(text, EXPLICIT), F.lit(UNKNOWN),
    )
