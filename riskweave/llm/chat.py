"""Chat formatting: roles recovered by a hidden Markov model, then one canonical rendering of turns.

States are the roles. Emissions are a speaker marker at the head of a turn ("User:", "### Assistant", "<|system|>") and
features of its lines: length, number of lines, whether it asks. Counts of roles, features and successions are taken
from turns whose role is given; Viterbi finds the most likely roles of a whole conversation. Long conversations are
cut into segments: each is first reduced to the best score from every first to every last role, the segments are
chained, and each is then decoded between the roles that the chain gives it. The result is that of one pass.

Raw transcripts are parsed by a model of their lines: each begins or continues a turn of a role, and every line, with
or without marker, is an observation.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.batches import bounds, whole_groups
from riskweave.llm.scratch import small_batches, store

ROLES = ("system", "user", "assistant")
#: Names that speak for a role.
ALIASES = {
    "system": ("system", "instruction", "instructions", "context"),
    "user": ("user", "human", "customer", "question", "prompter", "q"),
    "assistant": ("assistant", "ai", "bot", "model", "gpt", "agent", "answer", "response", "a"),
}
_NAMES = "|".join(sorted((n for names in ALIASES.values() for n in names), key=len, reverse=True))
#: Dressed name and colon, or a name inside a special token or heading.
MARKER = rf"(?i)^\s*(?:<\|(?:im_start\|>)?\s*({_NAMES})\s*(?:\|>)?|#{{1,6}}\s*({_NAMES})\s*:?\s*(?:\r?\n|$)|[*_\[]{{0,2}}({_NAMES})[*_\]]{{0,2}}\s*:[*_]{{0,2}})\s*"
MARKER_FEATURE = {"none": 0, **{role: n + 1 for n, role in enumerate(ROLES)}}
#: Values per feature: marker, length (powers of two), lines, question.
SIZES = (len(ROLES) + 1, 32, 6, 2)
#: A marker outweighs what lines and neighbours say, also where no training turn has one: pseudo-counts for right and wrong markers.
MARKER_RIGHT, MARKER_WRONG = 8.0, 1e-6
#: Turn numbers in a segment.
SEGMENT = 256
#: Parts of the conversations, by crc32 of conv_id; each is decoded by a model of the others.
FOLDS = 5


def known_role(role: Column) -> Column:
    """Canonical role of a given name, else null."""
    name = F.lower(F.trim(role))
    found = F.lit(None).cast("string")
    for canonical, names in ALIASES.items():
        found = F.when(name.isin(*names), canonical).otherwise(found)
    return found


def _marker(text: Column) -> Column:
    return F.coalesce(known_role(F.coalesce(*[F.when(F.length(F.regexp_extract(text, MARKER, n)) > 0, F.regexp_extract(text, MARKER, n)) for n in (1, 2, 3)])), F.lit("none"))


def _features(text: Column) -> Column:
    marker = F.lit(0)
    for name, value in MARKER_FEATURE.items():
        marker = F.when(_marker(text) == name, value).otherwise(marker)
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    return F.array(marker, F.least(F.lit(31), F.floor(F.log2(F.length(text) + 1))).cast("int"), F.least(F.lit(5), lines).cast("int"),
                   F.contains(text, F.lit("?")).cast("int"))


@dataclass
class RoleModel:
    start: np.ndarray
    step: np.ndarray
    emit: list[np.ndarray]
    lines: list[np.ndarray]  # as emit, for lines that begin a turn of each role, then for lines that continue one
    stay: np.ndarray  # per role, log probabilities that a line of a turn is its last and that another follows

    def scores(self, features: np.ndarray, given: np.ndarray) -> np.ndarray:
        """Log probability of each turn in each role; a given role (its number, else -1) leaves no other."""
        total = sum(table[:, features[:, n]].T for n, table in enumerate(self.emit))
        fixed = given >= 0
        total[fixed] = -1e9
        total[np.flatnonzero(fixed), given[fixed]] = 0.0
        return total

    def reduce(self, scores: np.ndarray) -> np.ndarray:
        """Best score from each first to each last role."""
        best = np.full((len(ROLES), len(ROLES)), -np.inf)
        np.fill_diagonal(best, scores[0])
        for row in scores[1:]:
            best = (best[:, :, None] + self.step[None]).max(axis=1) + row
        return best

    def decode(self, scores: np.ndarray, first: np.ndarray, last: int | None = None) -> np.ndarray:
        """Most likely roles, given scores of the first role, ending in ``last`` if given."""
        return _viterbi(scores, first, self.step, last)

    def decode_lines(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Role of each line of a transcript, and whether it begins a turn. With any marker, turns without one are unlikely."""
        n, marker, wrong = len(ROLES), features[:, 0], np.log(MARKER_WRONG)
        scores = sum(self.lines[f][:, features[:, f]].T for f in (1, 3))
        if marker.any():
            of_marker = self.emit[0][:, 1:] - np.log(np.exp(self.emit[0][:, 1:]).sum(axis=1, keepdims=True))
            scores[:, :n] += np.where(marker[:, None] > 0, of_marker[:, np.maximum(marker, 1) - 1].T, wrong)
            scores[:, n:] += np.where(marker[:, None] > 0, wrong, 0.0)
        begin = self.stay[0][:, None] + self.step
        go_on = np.where(np.eye(n, dtype=bool), self.stay[1][:, None], -np.inf)
        states = _viterbi(scores, np.concatenate([self.start, np.full(n, -np.inf)]), np.tile(np.hstack([begin, go_on]), (2, 1)))
        return states % n, states < n


def _viterbi(scores: np.ndarray, first: np.ndarray, step: np.ndarray, last: int | None = None) -> np.ndarray:
    best, back = first + scores[0], []
    for row in scores[1:]:
        paths = best[:, None] + step
        back.append(paths.argmax(axis=0))
        best = paths.max(axis=0) + row
    found = [int(best.argmax()) if last is None else last]
    for pointers in reversed(back):
        found.append(int(pointers[found[-1]]))
    return np.array(found[::-1])


def fold_of(conv_id: Column) -> Column:
    """0 to FOLDS - 1; 0 for null."""
    return F.coalesce(F.crc32(conv_id.cast("string")) % FOLDS, F.lit(0)).cast("int")


def _ordered(turns: DataFrame) -> DataFrame:
    """The turns with place (key of the conversation), segment, tie (order of turns with one number), features, given."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    given = F.lit(-1)
    for n, role in enumerate(ROLES):
        given = F.when(known_role(F.col("role")) == role, n).otherwise(given)
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    return rows.select(
        "*", F.when(F.col("conv_id").isNull(), F.concat(F.lit("row "), F.monotonically_increasing_id())).otherwise(F.col("conv_id").cast("string")).alias("place"),
        F.coalesce(F.floor(F.col("turn") / SEGMENT), F.lit(0)).cast("long").alias("segment"), F.xxhash64("text", "role").alias("tie"),
        _features(text).alias("features"), given.alias("given"), fold_of(F.col("conv_id")).alias("fold"))


def learn(turns: DataFrame) -> RoleModel:
    """Counts of all ``turns`` (conv_id, turn, role, text) whose role is a known name, smoothed by one."""
    return _model(_counts(turns), None)


def learn_others(turns: DataFrame) -> list[RoleModel]:
    """For each fold, the model of the turns of all other folds."""
    counts = _counts(turns)
    return [_model(counts, fold) for fold in range(FOLDS)]


def _counts(turns: DataFrame) -> tuple[list, list, list]:
    """Per fold: values of features, successions, and values of features of lines; bounded by the sizes of the model."""
    rows = _ordered(turns)
    known = rows.where("given >= 0")
    found = known.select("fold", "given", F.posexplode("features").alias("feature", "value")).groupBy("fold", "given", "feature", "value").count().collect()
    order = Window.partitionBy("place", "segment").orderBy(F.asc_nulls_first("turn"), "tie")
    # the first turn of a later segment has no predecessor at hand and is not counted
    pairs = rows.select("fold", "given", "segment", F.lag("given").over(order).alias("before"), F.row_number().over(order).alias("n")).where(
        "given >= 0 AND (before >= 0 OR (n = 1 AND segment = 0))").groupBy("fold", "before", "given").count().collect()
    written = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda line: F.length(F.trim(line)) > 0)
    lines = known.select("fold", "given", F.posexplode(written).alias("at", "line")).select(
        "fold", "given", (F.col("at") > 0).alias("later"), F.posexplode(_features(F.col("line"))).alias("feature", "value")).groupBy(
        "fold", "given", "later", "feature", "value").count().collect()
    return found, pairs, lines


def _model(counts: tuple[list, list, list], without: int | None) -> RoleModel:
    found, pairs, lines = ([r for r in rows if r["fold"] != without] for rows in counts)
    emit = [np.ones((len(ROLES), size)) for size in SIZES]
    emit[0] = np.full((len(ROLES), SIZES[0]), MARKER_WRONG)
    emit[0][:, 0] = 1.0
    for n in range(len(ROLES)):
        emit[0][n, n + 1] = MARKER_RIGHT
    for r in found:
        emit[r["feature"]][r["given"], r["value"]] += r["count"]
    start, step = np.ones(len(ROLES)), np.ones((len(ROLES), len(ROLES)))
    for r in pairs:
        if r["before"] is None:
            start[r["given"]] += r["count"]
        else:
            step[r["before"], r["given"]] += r["count"]
    of_lines, ends = [np.ones((2 * len(ROLES), size)) for size in SIZES], np.ones((2, len(ROLES)))
    for r in lines:
        of_lines[r["feature"]][r["given"] + r["later"] * len(ROLES), r["value"]] += r["count"]
        if r["feature"] == 0:
            ends[int(r["later"]), r["given"]] += r["count"]
    log = lambda x: np.log(x / x.sum(axis=-1, keepdims=True))
    return RoleModel(log(start), log(step), [log(e) for e in emit], [log(e) for e in of_lines], log(ends.T).T)


def _chain(rows: DataFrame, models: list[RoleModel]) -> DataFrame:
    """place, segment, entry, last: first and last role of each segment of the conversations that have several."""
    several = store(rows.groupBy("place").agg(F.min("segment").alias("a"), F.max("segment").alias("b")).where("a < b").select("place"), "several")
    keys = ["place", "segment"]
    schema = "place string, segment long, fold int, best array<double>"

    def reduce(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(frames, keys):
            at = bounds(frame, keys)
            features, given, folds = np.stack(frame["features"].to_numpy()), frame["given"].to_numpy(), frame["fold"].to_numpy()
            own = [models[folds[a] % len(models)] for a in at[:-1]]
            yield pd.DataFrame({"place": frame["place"].iloc[at[:-1]].to_numpy(), "segment": frame["segment"].iloc[at[:-1]].to_numpy(), "fold": folds[at[:-1]],
                                "best": [model.reduce(model.scores(features[a:b], given[a:b])).ravel() for model, a, b in zip(own, at, at[1:])]})

    def chain(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("segment")
        model = models[frame["fold"].iloc[0] % len(models)]
        best, back = model.start, []
        for n, matrix in enumerate(frame["best"]):
            into = (best[:, None] + model.step).max(axis=0) if n else best
            came = (best[:, None] + model.step).argmax(axis=0)
            paths = into[:, None] + np.array(matrix).reshape(len(ROLES), len(ROLES))
            back.append((paths.argmax(axis=0), came))
            best = paths.max(axis=0)
        entry, last, role = [], [], int(best.argmax())
        for of_last, came in reversed(back):
            last.append(role)
            entry.append(int(of_last[role]))
            role = int(came[entry[-1]])
        return pd.DataFrame({"place": frame["place"], "segment": frame["segment"], "entry": entry[::-1], "last": last[::-1]})

    parts = rows.join(several, "place", "left_semi").select(*keys, "turn", "tie", "features", "given", "fold")
    reduced = parts.repartition(*keys).sortWithinPartitions(*keys, F.asc_nulls_first("turn"), "tie").mapInPandas(reduce, schema)
    return store(reduced.groupBy("place").applyInPandas(chain, "place string, segment long, entry int, last int"), "chain")


def recover_roles(turns: DataFrame, model: RoleModel | list[RoleModel]) -> DataFrame:
    """conv_id, turn, role (as given), text, role_found per row of ``turns``.

    A given role with a known name stands; other names and nulls are recovered from the markers, the lines and the
    neighbours. Turns are ordered by number, nulls first, equal numbers by a hash of text and role; a row without
    conv_id is a conversation of its own. Null texts count as empty. Repeated rows are turns like any other; other
    columns are ignored; an empty table gives an empty result. Of a list of models, each conversation takes that of its
    fold.
    """
    models = model if isinstance(model, list) else [model]
    rows = _ordered(turns)
    keys = ["place", "segment"]
    dealt = rows.join(_chain(rows, models).drop("fold"), keys, "left").repartition(*keys).sortWithinPartitions(*keys, F.asc_nulls_first("turn"), "tie")
    kept = ["conv_id", "turn", "role", "text"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(frames, keys):
            at = bounds(frame, keys)
            features, given, folds = np.stack(frame["features"].to_numpy()), frame["given"].to_numpy(), frame["fold"].to_numpy()
            roles = np.empty(len(frame), np.int64)
            for a, b in zip(at, at[1:]):
                own = models[folds[a] % len(models)]
                scores = own.scores(features[a:b], given[a:b])
                entry, last = frame["entry"].iloc[a], frame["last"].iloc[a]
                if pd.isna(entry):
                    roles[a:b] = own.decode(scores, own.start)
                else:
                    only = np.full(len(ROLES), -np.inf)
                    only[int(entry)] = 0.0
                    roles[a:b] = own.decode(scores, only, int(last))
            yield frame[kept].assign(role_found=np.array(ROLES, object)[roles])

    return dealt.select(*keys, *kept, "features", "given", "fold", "entry", "last").mapInPandas(
        run, "conv_id long, turn long, role string, text string, role_found string")


def rendered(text: Column, role: Column) -> Column:
    """Canonical form of a turn: special token of the role, the text without its marker and outer white space, end token.

    What looks like a special token inside the text is parted by a space.
    """
    body = F.regexp_replace(F.coalesce(text, F.lit("")), MARKER, "")
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), F.replace(F.regexp_replace(body, r"^\s+|\s+$", ""), F.lit("<|"), F.lit("< |")), F.lit("<|end|>\n"))


def parse_transcript(text: str | None, model: RoleModel) -> list[tuple[str, str]]:
    """(role, text) turns of a raw transcript, by Viterbi over all its lines but blank ones."""
    lines = [line for line in (text or "").split("\n") if line.strip()]
    if not lines:
        return []
    pattern, features = re.compile(MARKER), []
    roles_of = {name: role for role, names in ALIASES.items() for name in names}
    for line in lines:
        found = pattern.match(line)
        name = next(filter(None, found.groups())).lower() if found else None
        features.append([MARKER_FEATURE[roles_of[name]] if name else 0, min(31, (len(line) + 1).bit_length() - 1), 1, int("?" in line)])
    turns: list[tuple[str, list[str]]] = []
    for line, role, begins in zip(lines, *model.decode_lines(np.array(features))):
        if begins:
            turns.append((ROLES[role], []))
        turns[-1][1].append(pattern.sub("", line))
    return [(role, "\n".join(part).strip()) for role, part in turns]


def parse_transcripts(texts: DataFrame, model: RoleModel) -> DataFrame:
    """conv_id, turn (from 0), role, text: the turns of each row of ``texts`` (conv_id, text), a whole transcript each.

    Null and blank texts have no turns; repeated rows are transcripts of their own; other columns are ignored.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for conv_id, text in zip(frame["conv_id"], frame["text"]):
                found = parse_transcript(text, model)
                if found:
                    yield pd.DataFrame({"conv_id": pd.array([conv_id] * len(found), "Int64"), "turn": range(len(found)),
                                        "role": [r for r, _ in found], "text": [t for _, t in found]})

    return small_batches(texts).select(F.col("conv_id").cast("long"), F.col("text").cast("string")).mapInPandas(
        run, "conv_id long, turn long, role string, text string")
