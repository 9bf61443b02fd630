"""Question-answer pairs whose answer can't be used, each with its defect.

Prompt and response are aligned as tokens: shingle containment finds candidates, and the longest common
subsequence decides whether an answer says nothing but the question, or is one of the known refusals.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.sources.tables import message, spread

DEFECTS = ["empty_answer", "refusal", "copies_question", "other_language", "truncated_answer"]
SHINGLE = 2
#: Least share of the question that an answer must repeat in order, and tokens it may add, to be a copy.
COPIED, ADDED = 0.9, 4
#: Least share of a refusal's tokens in order in a sentence of an answer, and tokens that the answer may spend on anything but
#: refusing and the two who speak.
REFUSED, FOLLOWING = 0.75, 25
#: Function words that a text needs at least before its language is judged.
LEAST_HITS = 2

#: What stands in place of an answer.
PLACEHOLDERS = {
    "n/a", "na", "n a", "none", "null", "nil", "nan", "tbd", "tba", "todo", "empty", "missing", "unknown", "undefined", "blank", "xxx", "no answer", "no response",
    "not available", "not applicable", "answer here", "your answer here", "placeholder", "insert answer", "to be determined", "pending", "lorem ipsum",
    "keine antwort", "k a", "leer", "sans réponse", "aucune réponse", "pas de réponse", "vide", "sin respuesta", "vacío", "ninguna", "s r",
}

#: Refusals, as they are worded.
REFUSALS = [
    "I'm sorry, but I can't help with that.", "I cannot provide an answer to this question.", "It would not be appropriate for me to answer this.",
    "As a language model I am unable to answer this from the image.", "I must decline to respond here.", "My guidelines do not allow me to discuss this.",
    "Unfortunately, I'm not able to assist with this request.", "I don't have enough access to the book to answer that.",
    "Sorry, the page image is not something I can read, so I won't answer.", "I am unable to help with this question.", "I can't answer that question.",
    "I'm not able to answer this question.", "I will not answer this question.", "I refuse to answer this question.", "As an AI language model, I cannot answer this question.",
    "Sorry, I cannot assist with that request.", "I am afraid I cannot help you with this.", "I do not have the information needed to answer this question.",
    "Es tut mir leid, dabei kann ich nicht helfen.", "Diese Frage kann ich leider nicht beantworten.", "Als Sprachmodell kann ich das nicht beantworten.",
    "Leider kann ich dazu keine Antwort geben.", "Ich darf diese Frage nicht beantworten.", "Dazu möchte ich mich nicht äußern.", "Als Assistent muss ich die Antwort ablehnen.",
    "Ich bin nicht in der Lage, diese Frage zu beantworten.", "Meine Richtlinien erlauben mir nicht, darüber zu sprechen.",
    "Je suis désolé, je ne peux pas vous aider.", "Il m'est impossible de traiter cette demande.", "En tant qu'assistant, je dois refuser.",
    "Je ne suis pas en mesure de répondre à cette question.", "Désolé, je ne peux pas répondre à cette question.", "Mes consignes ne me permettent pas d'en parler.",
    "Lo siento, no puedo ayudar con eso.", "No me es posible responder a esta pregunta.", "Como asistente, debo negarme a contestar.",
    "No puedo responder a esta pregunta.", "Como modelo de lenguaje, no puedo contestar a esto.", "Mis normas no me permiten hablar de esto.", "Lamentablemente no puedo atender esta solicitud.",
]

#: What a refusal is made of in any wording, per language: who speaks, that it isn't done, and what isn't done. Words are
#: given by their beginnings.
REFUSING = {
    "en": ("i we my me us our", "cannot can't won't wouldn't couldn't unable decline declin refus not no never rather outside beyond against forbid prohibit prevent permit", "answer help assist respond discuss comment compl provid address talk speak share go get say respond reply engage"),
    "de": ("ich wir mir uns mich meine meiner", "nicht kein keine keinen leider ablehn verweiger lehne außerhalb unmöglich untersag", "antwort beantwort helf weiterhelf sprech sag äuß auskunft besprech dien eingeh mitteil ablehn verweiger lehne"),
    "fr": ("je j nous me m mes moi", "ne n refus impossible désolé décline regret hors interdi", "répond répons aid trait parl dire discut fournir commenter aborder donner abord refus décline"),
    "es": ("me mi mis no lo yo puedo puede debo prefiero quiero", "no negar niego imposible lamento lamentablemente fuera prohib rechaz declin", "respond contest ayud habl decir coment trat atend proporcion dar entrar negar rechaz declin"),
}
#: Words of the two who speak, which tell nothing of the matter.
SPEAKERS = set("i i'm me my we us our you your yours please sorry ich mir mich mein meine wir uns sie ihnen ihr ihre bitte je j' moi mes nous vous votre vos désolé yo me mi mis usted su sus le lo siento".split())

#: Frequent words that are proper to one of the languages.
FUNCTION_WORDS = {
    "en": "the of and to in is it that was for on with as his they be at one have this from by had not but what all were when we there can an your which their said if will each about how up out them then she many some so these would other into has more her two him see could no than first been its who now did get come made may over under before after again once only where why near every such between another nobody people if look what which".split(),
    "de": "der die das und ist nicht ein eine einen einem einer den dem des zu von mit sich auf für im auch als aus bei nach wie über oder wenn wird werden sind hat haben kann noch nur so dass weil doch zwar kaum seit etwa durch gegen ohne um vor zwischen wer wo wann warum welche welcher welches wodurch woran inwiefern nennen sie ihr ihre am beim zur zum während bis sobald obwohl damit steht schon".split(),
    "fr": "le la les des du un une et est dans que qui ne pas pour sur avec au aux par plus ce cette ces il elle ils elles son sa ses leur leurs mais ou où donc comme si en se je vous nous tout tous très peut quand depuis pourquoi comment quel quelle quels quelles selon sans sous chez après avant entre puis ainsi certes souvent enfin seul environ ni on lit déjà de l d qu n s j".split(),
    "es": "el los las un una unos unas y es en que no se del al lo con por para como más pero sus su ya o este esta estos estas cuando muy sin sobre también hasta hay donde quien desde todo nos durante todos uno ni contra otros ese eso ante ellos entre qué cómo cuándo cuál cuáles dónde quién según tras solo cierto por eso aunque porque mientras siempre cada la de".split(),
}
#: Letters that are proper to one of the languages.
MARKS = {"de": set("äöüß"), "fr": set("èêçàùœîôûë"), "es": set("ñíóáú")}
_VOTES: dict[str, dict[str, float]] = {}
for _lang, _words in FUNCTION_WORDS.items():
    for _w in set(_words):
        _VOTES.setdefault(_w, {})[_lang] = 1.0
for _v in _VOTES.values():
    for _lang in _v:
        _v[_lang] = 1.0 / len(_v)
#: Names of languages as a question asks for them.
ASKED = {
    "en": r"\b(?:in|into) english\b|\b(?:auf|ins) englisch\w*|\ben anglais\b|\b(?:en|al) inglés\b",
    "de": r"\b(?:in|into) german\b|\b(?:auf|ins) deutsch\w*|\ben allemand\b|\b(?:en|al) alemán\b",
    "fr": r"\b(?:in|into) french\b|\b(?:auf|ins) französisch\w*|\ben français\b|\b(?:en|al) francés\b",
    "es": r"\b(?:in|into) spanish\b|\b(?:auf|ins) spanisch\w*|\ben espagnol\b|\b(?:en|al) español\b",
}
_ASKED = {k: re.compile(v, re.IGNORECASE) for k, v in ASKED.items()}
_TOKEN = re.compile(r"[^\W_]+")
_APOSTROPHE = re.compile(r"[^\W_]+(?:'[^\W_]+)?")
_SENTENCE = re.compile(r"[^.!?;\n]+")
_ENDS = ".!?。！？؟"
_CLOSERS = "\"'”’»)]}*_`>“‹›」"


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall(text.lower()) if text else []


def shingles(seq: list[str], n: int = SHINGLE) -> set[tuple[str, ...]]:
    return {tuple(seq[k : k + n]) for k in range(max(1, len(seq) - n + 1))} if seq else set()


def common_subsequence(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, one bit per token of ``a``."""
    places: dict[str, int] = {}
    for k, t in enumerate(a):
        places[t] = places.get(t, 0) | 1 << k
    mask, row = (1 << len(a)) - 1, (1 << len(a)) - 1
    for t in b:
        hit = row & places.get(t, 0)
        row = ((row + hit) | (row - hit)) & mask
    return len(a) - row.bit_count()


def is_empty(answer: str | None) -> bool:
    """Nothing but blanks, marks or a placeholder."""
    words = tokens(answer)
    if not words:
        return True
    text = " ".join(words)
    return len(words) <= 4 and (text in PLACEHOLDERS or (answer or "").strip().strip("[](){}<>*_-.").strip().lower() in PLACEHOLDERS)


@lru_cache(maxsize=1)
def _refusals() -> list[tuple[list[str], set]]:
    return [(t, shingles(t)) for t in map(tokens, REFUSALS)]


@lru_cache(maxsize=1)
def _refusal_heads() -> set[tuple[str, ...]]:
    return set().union(*(s for _, s in _refusals()))


@lru_cache(maxsize=1)
def _refusing() -> list[tuple[set[str], re.Pattern, re.Pattern]]:
    begins = lambda words: re.compile("|".join(map(re.escape, sorted(words.split(), key=len, reverse=True))))
    return [(set(who.split()), begins(no), begins(what)) for who, no, what in REFUSING.values()]


def _aligned(words: list[str]) -> bool:
    """Whether a sentence has the tokens of a known refusal in order, with few between."""
    some = shingles(words) & _refusal_heads()
    if len(some) < 2:
        return False
    for template, parts in _refusals():
        if len(some & parts) < 0.4 * len(parts):
            continue
        reach = len(template) + 4
        # stretches of a long sentence, each half over the one before
        for k in range(0, max(1, len(words) - reach + 1), max(1, reach // 2)):
            if common_subsequence(template, words[k : k + reach]) >= REFUSED * len(template):
                return True
    return False


def _worded(sentence: str) -> bool:
    """Whether a short sentence says that its speaker doesn't do what was asked, in whatever words."""
    words = _APOSTROPHE.findall(sentence.lower().replace("’", "'"))
    if not 3 <= len(words) <= 22:
        return False
    for who, no, what in _refusing():
        speaker = [k for k, w in enumerate(words) if w.split("'")[0] in who]
        denied = [k for k, w in enumerate(words) if no.match(w)]
        done = [k for k, w in enumerate(words) if what.match(w)]
        # the three stand close together: nothing else is told
        if speaker and denied and done and any(abs(s - d) <= 6 and abs(d - x) <= 7 for s in speaker for d in denied for x in done):
            return True
    return False


def is_refusal(answer: str) -> bool:
    """An answer with a sentence that declines, and little else but the two who speak.

    Sentences of the whole answer are aligned with the known refusals. One that is only worded as a refusal counts where it
    stands first or last and the answer tells nothing besides.
    """
    words = tokens(answer)
    templates = len(shingles(words) & _refusal_heads()) >= 2
    speakers = any(not who.isdisjoint(words) for who, _, _ in _refusing())
    if not templates and not speakers:
        return False
    sentences = [(x, tokens(x)) for x in _SENTENCE.findall(answer)]
    known = [templates and _aligned(words) for _, words in sentences]
    if any(known):
        told = sum(len(words) for k, (x, words) in zip(known, sentences) if not k and SPEAKERS.isdisjoint(words) and not _worded(x))
        return told <= FOLLOWING
    ends = [k for k in {0, len(sentences) - 1} if speakers and sentences and _worded(sentences[k][0])]
    return bool(ends) and all(not SPEAKERS.isdisjoint(words) or not words or k in ends or _worded(x) for k, (x, words) in enumerate(sentences))


def is_copy(question: list[str], answer: list[str]) -> bool:
    """Nothing but the question, with at most a few words around it."""
    if not question or len(answer) > len(question) + ADDED or len(answer) < COPIED * len(question):
        return False
    parts = shingles(question)
    if len(parts & shingles(answer)) < 0.6 * len(parts):
        return False
    same = common_subsequence(question, answer)
    return same >= COPIED * len(question) and len(answer) - same <= ADDED


def language(words: list[str]) -> str | None:
    """Language by function words; None where there are too few or two languages are close."""
    votes = dict.fromkeys(FUNCTION_WORDS, 0.0)
    for w in words:
        for lang, v in _VOTES.get(w, {}).items():
            votes[lang] += v
        if not w.isascii():
            for lang, marks in MARKS.items():
                if not marks.isdisjoint(w):
                    votes[lang] += 0.7
    first, second = sorted(votes, key=votes.get, reverse=True)[:2]
    return first if votes[first] >= LEAST_HITS and votes[first] >= 1.5 * votes[second] else None


def asked_languages(question: str) -> set[str]:
    return {lang for lang, p in _ASKED.items() if p.search(question)}


def is_truncated(answer: str) -> bool:
    """Breaks off before its sentence ends. A closing quote or bracket after the end of a sentence or around a whole
    remark is an end too; a list whose other items have no full stop may end without one."""
    text = answer.strip()
    bare = text.rstrip(_CLOSERS + " \n\t")
    if text.endswith(("...", "…")):
        return True
    if not bare:
        return False
    if bare[-1] in _ENDS:
        return False
    if len(bare) < len(text):
        opened = text.rfind("(") if text[-1] == ")" else text.rfind("[") if text[-1] == "]" else -1
        # a remark in brackets that follows the end of a sentence
        return not (opened >= 0 and (text[:opened].rstrip()[-1:] in _ENDS or not text[:opened].strip()))
    lines = [line.strip() for line in text.split("\n") if line.strip()]
    item = re.compile(r"^(?:[-*•–]|\d+[.)]|[a-z]\))\s")
    if len(lines) > 1 and item.match(lines[-1]) and bare[-1] not in ",;:(-–" and all(x[-1] not in _ENDS for x in lines[:-1] if item.match(x)) and any(item.match(x) for x in lines[:-1]):
        return False
    # one word or number alone answers a question
    return not (len(text.split()) <= 2 and bare[-1].isalnum())


def defect(question: str | None, answer: str | None) -> str | None:
    """Defect of a pair, or None for a sound one. A null question copies nothing and has no language."""
    if is_empty(answer):
        return "empty_answer"
    q, a = tokens(question), tokens(answer)
    if is_refusal(answer):
        return "refusal"
    if is_copy(q, a):
        return "copies_question"
    said = language(a)
    if said and q:
        wanted = language(q)
        if wanted and said != wanted and said not in asked_languages(question):
            return "other_language"
    return "truncated_answer" if is_truncated(answer) else None


def _judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = pdf[["source_table", "row_id", "qa_index"]].assign(defect=[defect(q, a) for q, a in zip(pdf["question"], pdf["answer"])])
        yield out[out["defect"].notna()]


def pairs_of(pages: DataFrame, records: DataFrame) -> DataFrame:
    """``(source_table, row_id, qa_index, question, answer)`` of both tables. Null messages make no pair; a record
    without an assistant message is a pair with a null answer. Null entries of accepted_qas are pairs of nulls."""
    said = records.where("messages is not null and record_id is not null").select(
        F.lit("chatml_dataset").alias("source_table"), F.col("record_id").alias("row_id"), F.lit(0).alias("qa_index"), message("user").alias("question"), message("assistant").alias("answer"))
    kept = pages.where("artifact_id is not null").select(F.col("artifact_id").alias("row_id"), F.posexplode("accepted_qas").alias("qa_index", "qa"))
    return said.unionByName(kept.select(F.lit("page_artifacts").alias("source_table"), "row_id", "qa_index", F.col("qa.question").alias("question"), F.col("qa.answer").alias("answer")))


def defective_pairs(pages: DataFrame, records: DataFrame) -> DataFrame:
    """``(source_table, row_id, qa_index, defect)``, one row per defective pair; repeated rows count once."""
    judged = spread(pairs_of(pages, records)).mapInPandas(_judge, "source_table string, row_id long, qa_index int, defect string")
    return judged.dropDuplicates(["source_table", "row_id", "qa_index"])
