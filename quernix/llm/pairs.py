"""Defective prompt and response pairs: empty, truncated, refusing, copying the question, or in another language.

A suffix automaton of the prompt's words measures how much of a response is copied; automata over phrases find
refusals; a stack of delimiters finds structures left open; votes of stopwords tell languages. Whether an unpunctuated
end is an end is told by how often the same words end a sentence or a line elsewhere in all responses.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernix.functions.words import fold, split_words, words
from quernix.operators.skew import salted_join
from quernix.runtime import ship, stage

STAND_INS = frozenset(
    "null none nil nan na tbd tba todo nooutput nooutputs empty noanswer noresponse noreply undefined notavailable unknown missing blank novalue notapplicable nodata noresult nocontent keineantwort leer sansréponse vide sinrespuesta vacío".split()
)
#: Ways to decline, per language: what can't or mustn't be done (every start with every verb), and set phrases.
_DECLINING = {
    "en": (
        ("can't", "cannot", "can not", "won't", "will not", "unable to", "not able to", "won't be able to", "not be able to", "do not", "don't", "not in a position to", "not going to"),
        ("help", "assist", "answer", "provide", "comply", "discuss", "fulfil", "handle", "advise", "engage", "give guidance", "give an answer", "take part", "do that for you", "do this for you", "respond"),
        ("to decline", "must decline", "i decline", "i refuse", "to refuse", "must refuse", "not allowed to", "not permitted to", "rather not", "not comfortable", "turn this down", "turn that down", "turn it down", "against my", "no answer", "ask someone else", "ask somebody else", "not something i"),
    ),
    "de": (
        ("nicht", "nicht weiter", "keine", "dazu nichts", "darüber nichts"),
        ("helfen", "weiterhelfen", "beantworten", "antworten", "erlaubt", "gestattet", "auskunft", "antwort geben", "hilfe", "unterstützen", "in der lage", "sagen"),
        ("ablehnen", "verweigern", "muss passen", "lehne das ab", "lehne ich ab"),
    ),
    "fr": (
        ("ne peux pas", "ne puis", "ne suis pas en mesure", "impossible de", "ne suis pas autorisé à", "ne suis pas autorisée à", "ne saurais"),
        ("vous aider", "t'aider", "aider", "répondre", "donner", "fournir", "traiter", "vous répondre", "te répondre", "assister"),
        ("décliner", "dois refuser", "je refuse", "de refuser", "pas autorisé", "pas en mesure", "pas le droit"),
    ),
    "es": (
        ("no puedo", "no me es posible", "no podré", "no voy a", "no soy capaz de", "no estoy en condiciones de", "no sé"),
        ("ayudar", "ayudarte", "ayudarle", "responder", "contestar", "dar", "proporcionar", "atender", "hacerlo", "hacer eso"),
        ("negarme", "rechazar", "rehusar", "no estoy autorizad", "no me está permitido", "no se me permite", "me niego", "declinar"),
    ),
}
REFUSALS = tuple(sorted({x for starts, verbs, fixed in _DECLINING.values() for x in (*(f"{s} {v}" for s in starts for v in verbs), *fixed)}))
#: Function words: articles, pronouns, prepositions, conjunctions, auxiliaries and their like.
STOPWORDS = {
    "en": "the a an and or but nor so yet if then than because while of to in into on onto at by for from with without about over under after before between through during against is are was were be been being am do does did done has have had having can could should would will shall may might must i you he she it we they me him her us them my your his its our their this that these those who whom whose which what when where why how there here not no yes all any both each few many more most much none only other some such same own too very just also already again once now ever never please else like up down out off".split(),
    "de": "der die das den dem des ein eine einen einem einer eines kein keine keinen und oder aber denn sondern wenn weil dass ob als wie so dann doch von zu zum zur im in ins an am ans auf aus bei beim mit nach vor über unter durch für gegen ohne um bis seit zwischen ist sind war waren wird werden wurde sein bin hat haben hatte kann können soll sollte sollen muss müssen darf will möchte ich du er sie es wir ihr mich dich ihn uns euch mir dir ihm ihnen mein dein unser dieser diese dieses diesen diesem welche welcher welches was wer wo wann warum wie nicht nein ja nur auch noch schon sehr mehr alle alles jede jeder jedes beide beides man sich hier dort da dabei dazu danach davor daran damit einmal bitte immer zuerst".split(),
    "fr": "le la les l un une des du de d et ou mais donc car ni or que qui quoi dont où quand comment pourquoi quel quelle quels quelles à au aux dans en sur sous par pour avec sans vers chez entre avant après depuis pendant contre est sont était étaient être été sera suis es a ont avait avoir ai peut peuvent faut doit dois devez je j tu il elle on nous vous ils elles me m te t se s lui leur y mon ma mes ton ta tes son sa ses notre nos votre vos ce c cet cette ces ne n pas non oui plus moins très tout toute tous toutes aucun aucune autre autres même si puis ainsi aussi alors encore seulement deux ici là fois chaque".split(),
    "es": "el la los las lo un una unos unas y e o u pero sino porque que quien cual cuál cuáles cuando cuándo donde dónde como cómo qué por para con sin de del a al en sobre bajo entre hasta desde hacia contra según durante antes después es son era eran ser está están estar fue sido soy ha han había haber hay he puede pueden puedo debe deben debo tiene tienen yo tú él ella ello nosotros ellos ellas usted ustedes me te se le les nos mi mis tu tus su sus nuestro este esta esto estos estas ese esa eso esos esas no sí ni más menos muy todo toda todos todas ambos ambas ninguno ninguna otro otra mismo si luego así también ya aún solo sólo aquí allí cada vez".split(),
}
LANGUAGE_NAMES = {
    "en": "english englisch englische englischer anglais inglés ingles".split(),
    "de": "german deutsch deutsche deutscher allemand alemán aleman".split(),
    "fr": "french französisch französische français francais francés frances".split(),
    "es": "spanish spanisch spanische espagnol español espanol castellano".split(),
}
_VOTES: dict[str, frozenset[str]] = {}
for _language, _list in STOPWORDS.items():
    for _w in _list:
        _VOTES[_w] = _VOTES.get(_w, frozenset()) | {_language}

_TAG = re.compile(r"</?\w[^<>]*>")
_FENCE_LINE = re.compile(r"```\w*")
_FENCED = re.compile(r"```.*?(?:```|\Z)", re.S)
_INLINE = re.compile(r"`[^`\n]*`")
_QUOTED = re.compile(r"«[^»]*»|„[^“]*“")
_PATH = re.compile(r"(?<!\S)[^\s/_\\]*[/_\\]\S*|\b\w+\.\w{1,8}\b")
_KEY = re.compile(r'"\w+"\s*:')
_COMMAND = re.compile(r"\$\(|&&|\|\s*\w+ |\s--?\w+[= ]\S|\s-\w\b|;\s*(?:echo|do|done)\b|>\s*/|^[^\S\n]*(?:\$|#|for|while|cd|cat|echo|ls|grep|sed|awk)\s", re.M)
_BULLET = re.compile(r"^\s*(?:[-*•+]|\d+[.)])\s+")
_CUT_PATH = re.compile(r"(?:/[\w/-]+|\b\w+_\d+)\.$")
_BROKEN_COMMAND = re.compile(r"(?:[|&>=/\\$(]|\s-+|\bdo)$")
_BROKEN_END = re.compile(r"[,;:(\[{«=&|\\-]$")
_SENTENCES = re.compile(r"[.!?\n]+")
_END = re.compile(r"[.!?…][\"'»”)*]*(?=\s|\Z)|\n")
_DIGITS = re.compile(r"\d+")
_PLAIN_START = re.compile(r"\s*[\w-]")
_LETTERS = re.compile(r"[^\W\d_]{3,}")


def _automaton(phrases: tuple[str, ...]) -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for p in phrases:
        a.add_word(p, p)
    a.make_automaton()
    return a


@lru_cache(maxsize=1)
def _triggers() -> ahocorasick.Automaton:
    """The longest word of each way to decline; without any of them nothing declines, however it is spaced and marked."""
    return _automaton(tuple({max(split_words(p), key=len) for p in REFUSALS}))


class WordAutomaton:
    """Suffix automaton of a sequence of words."""

    def __init__(self, seq: list[str]) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length, last = [-1], [0], 0
        for w in seq:
            cur = self._state(self.length[last] + 1, {})
            p = last
            while p >= 0 and w not in self.next[p]:
                self.next[p][w] = cur
                p = self.link[p]
            if p < 0:
                self.link[cur] = 0
            else:
                q = self.next[p][w]
                if self.length[p] + 1 == self.length[q]:
                    self.link[cur] = q
                else:
                    clone = self._state(self.length[p] + 1, dict(self.next[q]))
                    self.link[clone] = self.link[q]
                    while p >= 0 and self.next[p].get(w) == q:
                        self.next[p][w] = clone
                        p = self.link[p]
                    self.link[q] = self.link[cur] = clone
            last = cur

    def _state(self, length: int, edges: dict[str, int]) -> int:
        self.next.append(edges)
        self.link.append(-1)
        self.length.append(length)
        return len(self.next) - 1

    def covered(self, seq: list[str], least: int) -> list[bool]:
        """Which words of seq lie in a run of at least `least` words of the automaton's sequence."""
        out, state, run = [False] * len(seq), 0, 0
        for k, w in enumerate(seq):
            while state and w not in self.next[state]:
                state = self.link[state]
                run = self.length[state]
            if w in self.next[state]:
                state, run = self.next[state][w], run + 1
            else:
                run = 0
            if run >= least:
                out[k - run + 1 : k + 1] = [True] * run
        return out


def is_empty(answer: str) -> bool:
    if _PLAIN_START.match(answer) and "<" not in answer and len(_LETTERS.findall(answer, 0, 120)) > 3:
        return False  # more words than any stand-in has, and no markup
    text = answer.strip()
    if text[:1] in "{[\"" and text:
        try:
            todo, found = [json.loads(text)], False
            while todo:
                x = todo.pop()
                todo += list(x.values()) if isinstance(x, dict) else x if isinstance(x, list) else []
                found = found or not isinstance(x, (dict, list, type(None), str)) or isinstance(x, str) and not is_empty(x)
            if not found:
                return True
        except (ValueError, RecursionError):
            pass
    text = _FENCE_LINE.sub(" ", _TAG.sub(" ", text)).replace("&nbsp;", " ")
    core = "".join(words(text))
    return not core or core in STAND_INS


_MARKUP = (("’", "'"), ("`", "'"), *((x, " ") for x in '*_#>"'))
_SPACING = re.compile(r"[^\S\n]{2,}|[^\S\n ]")
#: Words of a sentence that declines, and of one beside it that only is polite, at most.
_LONGEST_DECLINING, _LONGEST_COURTESY = 24, 14


def is_refusal(folded: str, asked: list[str], refusals: ahocorasick.Automaton) -> bool:
    """Declines, and no sentence of it answers anything: each declines, or is short and takes up nothing of the question,
    as thanks, regrets and advice to go elsewhere do. folded: the answer in folded form; asked: words of the question."""
    # typographic apostrophes, markup and odd spacing don't count; sentence marks and line ends do
    if not next(_triggers().iter(folded), None):
        return False
    text = folded
    for mark, instead in _MARKUP:
        text = text.replace(mark, instead)
    text = _SPACING.sub(" ", text)
    if not next(refusals.iter(text), None):
        return False
    matter = {w for w in asked if w not in _VOTES and len(w) > 1}
    for sentence in _SENTENCES.split(text):
        ws = split_words(sentence)
        if not ws:
            continue
        if _PATH.search(sentence) or any(w.isdecimal() for w in ws):
            return False
        if next(refusals.iter(sentence), None):
            if len(ws) > _LONGEST_DECLINING:
                return False
        elif len(ws) > _LONGEST_COURTESY or matter.intersection(ws):
            return False
    return True


def is_copy(answer: str, asked: list[str], said: list[str]) -> bool:
    """Nothing but the question again: copied runs make most of both, and no answer follows."""
    if len(asked) < 3 or not said:
        return False
    known = set(asked)
    if sum(w in known for w in said) < 0.7 * len(said):
        return False  # no run can cover more than the words in common
    hit = WordAutomaton(asked).covered(said, 2)
    n = sum(hit)
    if n < 0.7 * len(said) or n < 0.6 * len(asked):
        return False
    last = max(k for k, x in enumerate(hit) if x)
    after = len(said) - 1 - last
    if not after:
        return True
    # something after the copy, set apart from it, is an answer
    lines = [x for x in re.split(r"\n\s*\n|\n", answer.strip()) if words(x)]
    tail = len(words(lines[-1])) if len(lines) > 1 else 0
    return after <= 2 and not (0 < tail <= after)


def languages(text: str) -> Counter:
    if "```" in text:
        text = _FENCED.sub(" ", text)
    if _COMMAND.search(text):
        text = "\n".join([x for x in text.split("\n") if not _COMMAND.search(x)])
    if "`" in text:
        text = _INLINE.sub(" ", text)
    if "«" in text or "„" in text:
        text = _QUOTED.sub(" ", text)
    if '":' in text:
        text = _KEY.sub(" ", text)
    return _votes(words(_PATH.sub(" ", text)))


def _votes(ws: list[str]) -> Counter:
    votes: Counter = Counter()
    for who, n in Counter(filter(None, map(_VOTES.get, ws))).items():
        for language in who:
            votes[language] += n / len(who)
    return votes


def _clear(votes: Counter) -> str | None:
    """Language that wins by so much that names and commands in the text can't have decided it."""
    top = votes.most_common(2)
    return top[0][0] if top and top[0][1] >= 3 and (len(top) == 1 or top[0][1] >= 4 * top[1][1]) else None


def _winner(votes: Counter, sure: float) -> str | None:
    top = votes.most_common(2)
    if not top or top[0][1] < sure:
        return None
    return top[0][0] if len(top) == 1 or top[0][1] >= 1.5 * top[1][1] else None


def is_other_language(question: str, answer: str, asked_words: list[str], said_words: list[str]) -> bool:
    if (clear := _clear(_votes(said_words))) and clear == _clear(_votes(asked_words)):
        return False
    asked = _winner(languages(question), 2)
    votes = languages(answer)
    said = _winner(votes, 1 if len(words(answer)) <= 5 else 2)
    if not asked or not said or asked == said:
        return False
    wanted = set(LANGUAGE_NAMES[said])
    return not wanted & set(words(question))


_CLOSES = {")": "(", "»": "«", "“": "„"}
_BRACKETS = re.compile("[()«»„“]")


def open_structure(answer: str) -> bool:
    """A code block, inline code, quote or bracketed structure that was begun and not ended."""
    text = answer.rstrip()
    fences = text.count("```")
    if fences % 2:
        return True
    outside = _FENCED.sub(" ", text).strip() if fences else text.strip()
    if outside[:1] in ("{", "[") and outside:
        try:
            json.loads(outside)
            return False
        except ValueError:
            stack, in_string, skip = [], False, False
            for ch in outside:
                if skip:
                    skip = False
                elif in_string:
                    skip, in_string = ch == "\\", ch != '"'
                elif ch == '"':
                    in_string = True
                elif ch in "{[":
                    stack.append(ch)
                elif ch in "}]" and stack:
                    stack.pop()
            return bool(stack) or in_string
    last = outside.rsplit("\n", 1)[-1]
    if last.count("`") % 2:
        return True
    found = _BRACKETS.findall(last)
    if not found or _COMMAND.search(last):
        return False
    stack = []
    for ch in found:
        if ch not in _CLOSES:
            stack.append(ch)
        elif stack and stack[-1] == _CLOSES[ch]:
            stack.pop()
    return bool(stack)


def loose_end(answer: str) -> tuple[bool, str | None]:
    """(broken, tail): broken if the end itself shows it; tail if only the last words, given in it, can tell."""
    text = answer.rstrip().rstrip("*_").rstrip()
    if not text or text.endswith("```"):
        return False, None
    outside = _FENCED.sub(" ", text).strip()
    if outside[:1] in ("{", "["):
        return False, None
    last = text.rsplit("\n", 1)[-1]
    if _BROKEN_END.search(text) and not _COMMAND.search(last):
        return True, None
    if _COMMAND.search(last) and not _BULLET.match(last) and _BROKEN_COMMAND.search(last):
        return True, None
    if text[-1] in ".!?…\"'”»`)}]":
        return bool(text[-1] == "." and _CUT_PATH.search(text)), None
    if _COMMAND.search(last) and not _BULLET.match(last):
        return False, None
    ws = _shape(words(last))
    if not ws or len(ws) == 1 and len(words(text)) == 1:
        return False, None
    kind = "b" if _BULLET.match(last) else "p"
    return False, f"{kind}\t{ws[-2] if len(ws) > 1 else ''}\t{ws[-1]}"


def _shape(ws: list[str]) -> list[str]:
    return [w if w.isalpha() else _DIGITS.sub("9", w) for w in ws]


def count_ends(parts: list[list[str]], ends: Counter, every: Counter) -> None:
    """Adds how often each (previous word, word) ends a sentence or line of an answer, given as the words of its
    sentences and lines, and how often it occurs at all. The unpunctuated end of the text itself counts as neither."""
    for k, ws in enumerate(parts):
        if ws:
            ws = _shape(ws)
            pairs = list(zip(["", *ws], ws, strict=False))
            if k < len(parts) - 1:
                ends[pairs[-1]] += 1
            else:
                pairs.pop()
            every.update(pairs)


def judge(question: str | None, answer: str | None, folded: str, said: list[str], refusals: ahocorasick.Automaton) -> tuple[str | None, str | None]:
    """(defect, tail) of a pair; tail as in loose_end, where only other answers can tell. folded: the answer folded; said: its words."""
    if answer is None or is_empty(answer):
        return "empty", None
    question = question or ""
    asked = words(question)
    if is_copy(answer, asked, said):
        return "copy", None
    if is_refusal(folded, asked, refusals):
        return "refusal", None
    if _speaks_otherwise(question, answer, asked, said):
        return "other_language", None
    if open_structure(answer):
        return "truncated", None
    broken, tail = loose_end(answer)
    return ("truncated", None) if broken else (None, tail)


#: Pairs of words that a task counts before it hands them on.
_COUNTED_TOGETHER = 300_000
_JUDGED = "turn bigint, defect string, kind string, before string, word string, ends bigint, n bigint"


def _inspect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In one pass: a row of each pair that has a defect or a tail, and rows with n of the ends of sentences and lines."""
    refusals = _automaton(REFUSALS)
    names = ["trial_name", *(x.split()[0] for x in _JUDGED.split(", "))]
    ends: Counter = Counter()
    every: Counter = Counter()
    kind = None

    def counts() -> pa.RecordBatch:
        none = [pa.nulls(len(every), t) for t in (kind, pa.int64(), pa.string(), pa.string())]
        keys = list(every)
        out = [*none, pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([ends[k] for k in keys], pa.int64()), pa.array(list(every.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(out, names=names)

    for b in batches:
        kind, told = b.column("trial_name").type, []
        for k, (q, a) in enumerate(zip(b.column("question").to_pylist(), b.column("answer").to_pylist(), strict=True)):
            folded = fold(a) if a else ""
            parts = [split_words(x) for x in _END.split(folded)]
            count_ends(parts, ends, every)
            defect, tail = judge(q, a, folded, [w for ws in parts for w in ws], refusals)
            if defect or tail:
                told.append((k, defect, *(tail.split("\t") if tail else (None, None, None))))
        at = pa.array([t[0] for t in told], pa.int64())
        strings = [pa.array([t[k] for t in told], pa.string()) for k in range(1, 5)]
        yield pa.RecordBatch.from_arrays([b.column("trial_name").take(at), b.column("turn").take(at), *strings, pa.nulls(len(told), pa.int64()), pa.nulls(len(told), pa.int64())], names=names)
        if len(every) > _COUNTED_TOGETHER:
            yield counts()
            ends.clear()
            every.clear()
    if every:
        yield counts()


def _speaks_otherwise(question: str, answer: str, asked: list[str], said: list[str]) -> bool:
    # of a single line nothing would be left
    if "\n" in answer and (own := _without_copy(answer, asked)) != answer:
        answer, said = own, words(own)
    return is_other_language(question, answer, asked, said)


def _without_copy(answer: str, asked: list[str]) -> str:
    """The answer without lines that repeat some of the question's words."""
    whole = " ".join(asked)
    lines = [x for x in answer.split("\n") if not (len(w := words(x)) > 3 and " ".join(w) in whole)]
    return "\n".join(lines) if any(words(x) for x in lines) else answer


#: Share of its other occurrences in which the last words have to end a sentence or line for the end to be complete.
LEAST_END_SHARE = 0.15


def defective_pairs(df: DataFrame, id_col: str, turns: str) -> DataFrame:
    """(id_col, turn, defect) of each defective pair in turns, an array of (role, content): a user message and the
    assistant message right after it, turn being the latter's place. At most one defect a pair.

    Defined cases: a null answer is empty; a null question can't be copied and has no language; null turns, ids and
    roles make no pair; a repeated row comes out once; rows of one id with different turns are judged each for itself; an
    empty table gives an empty one; where the table is too small to know the last words, an unpunctuated end of a list
    item counts as an end and that of a sentence doesn't.
    """
    ship(df.sparkSession)
    n = F.size(turns)
    pairs = (
        df.where(F.col(id_col).isNotNull() & (n > 1))
        .select(F.col(id_col).alias("trial_name"), F.col(turns).alias("m"))
        .select("trial_name", F.explode(F.expr("transform(filter(sequence(1, size(m) - 1), i -> m[i].role = 'assistant' AND m[i - 1].role = 'user'), i -> struct(CAST(i AS BIGINT) AS turn, m[i - 1].content AS question, m[i].content AS answer))")).alias("p"))
        .select("trial_name", "p.turn", "p.question", "p.answer")
    )
    kind = df.select(id_col).schema[0].dataType.simpleString()
    seen = stage(pairs.mapInArrow(_inspect, f"trial_name {kind}, {_JUDGED}"), "judged")
    judged = seen.where("n is null")
    sure = judged.where("defect is not null").select("trial_name", "turn", "defect")
    loose = judged.where("defect is null").select("trial_name", "turn", "kind", "before", "word")
    pair_ends = stage(seen.where("n is not null").groupBy("before", "word").agg(F.sum("ends").alias("pe"), F.sum("n").alias("pn")), "ends")
    word_ends = pair_ends.groupBy("word").agg(F.sum("pe").alias("we"), F.sum("pn").alias("wn"))
    before_ends = pair_ends.groupBy("before").agg(F.sum("pe").alias("be"), F.sum("pn").alias("bn"))
    # judged once for each end, however many answers have it
    tails = loose.select("kind", "before", "word").distinct()
    told = tails.join(pair_ends, ["before", "word"], "left").join(word_ends, "word", "left").join(before_ends, "before", "left")
    # a last word that is hardly known is told by what follows the word before it
    unknown = F.when(F.col("kind") == "p", 0.0).when(F.col("bn") >= 3, F.col("be") / F.col("bn")).otherwise(1.0)
    share = F.when(F.col("pn") >= 3, F.col("pe") / F.col("pn")).when(F.col("wn") >= 3, F.col("we") / F.col("wn")).otherwise(unknown)
    cut_tails = told.where(share < LEAST_END_SHARE).select("kind", "before", "word")
    cut = salted_join(loose, cut_tails, ["kind", "before", "word"], F.xxhash64("trial_name", "turn"), "inner").select("trial_name", "turn", F.lit("truncated").alias("defect"))
    return sure.unionByName(cut).distinct().withColumnRenamed("trial_name", id_col)
