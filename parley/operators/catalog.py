"""The catalog of labels: what each needs and carries, what a dataset supports, and which a consumer selects."""

from __future__ import annotations

import difflib
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a dataset may provide, and what a label's information may be.
FACTS = ("speech", "words", "transcript", "social.looking", "social.talking", "face_tracks", "media.audio", "media.video", "meta.background", "meta.native_speaker", "meta.host", "meta.source_offset")
MODALITIES = ("audio", "text", "video", "metadata")

#: The labels of each family, with the family's usual modalities and facts.
_FAMILIES: dict[str, tuple[str, str, str]] = {
    "instantaneous": ("audio", "speech", "speaker_activity_subframes speaker_activity ego_speaking_subframes ego_speaking others_active_subframes others_active joint_speech_state_subframes joint_speech_state_occupancy active_speaker_count_subframes floor_holder_subframes"),
    "events": ("audio", "speech", "speaker_onset_subframes speaker_offset_subframes speaker_transition_valid_subframes ego_onset_subframes ego_offset_subframes other_onset_subframes other_offset_subframes floor_change_subframes previous_floor_holder_subframes next_floor_holder_subframes speaker_onsets speaker_offsets"),
    "onset_context": ("audio", "speech", "previous_unique_speaker_subframes ego_was_last_unique_speaker_subframes others_active_at_ego_onset_subframes silence_duration_before_ego_onset_subframes simultaneous_other_onset_subframes ego_onset_context_valid_subframes ego_onset_type_subframes"),
    "overlap": ("audio", "speech", "within_overlap_subframes between_overlap_subframes simultaneous_onset_overlap_subframes overlap_events"),
    "timing": ("audio", "speech", "time_since_ego_onset time_since_ego_offset time_since_other_onset time_since_other_offset time_since_speaker_activity time_since_floor_change time_to_next_ego_onset time_to_next_ego_offset time_to_next_other_onset time_to_next_other_offset time_to_next_floor_change time_to_next_speaker_onset silence_duration observation_bounds silences"),
    "turns": ("audio", "speech", "speech_runs turns floor_transfers"),
    "next_speaker": ("audio", "speech", "next_speaker next_unique_speaker current_speaker_continues floor_transfer_target"),
    "future": ("audio", "speech", "future_speaker_activity future_ego_activity future_others_activity future_joint_speech_state future_floor_holder future_overlap future_ego_onset future_ego_offset future_other_onset future_other_offset future_next_speaker"),
    "prosody": ("audio", "speech media.audio", "ego_f0_hz ego_voiced_fraction ego_rms_db ego_solo_mask_fraction"),
    "text": ("text", "speech transcript", "tokens speech_rate final_punctuation interrogative_cue turn_final_token discourse_markers"),
    "social_native": ("video", "speech", "looking_at_wearer_subframes talking_to_wearer_subframes anyone_looking_at_wearer_subframes anyone_talking_to_wearer_subframes face_tracked_subframes face_track_bbox social_segments face_tracks"),
    "profiles": ("audio", "speech", "speaking_time turn_statistics pause_statistics onset_offset_counts overlap_statistics floor_transfer_statistics interaction_profile_features interaction_profile_feature_names"),
    "nuisance": ("video", "media.video", "global_audio_rms zero_crossing_rate spectral_centroid spectral_bandwidth spectral_flux spectral_valid background_noise_proxy audio_valid frame_mean_rgb brightness contrast saturation blur_score dominant_colour frame_difference frame_valid"),
    "metadata": ("metadata", "", "recording_identity participants recording_span source_offset background_conditions participant_identity participant_native_speaker participant_is_host"),
}
#: Labels that need or carry something else than their family.
_OTHERS = {
    "text.speech_rate": ("text audio", "speech words"),
    "social_native.looking_at_wearer_subframes": ("video", "speech social.looking face_tracks"),
    "social_native.anyone_looking_at_wearer_subframes": ("video", "speech social.looking face_tracks"),
    "social_native.talking_to_wearer_subframes": ("audio video", "speech social.talking"),
    "social_native.anyone_talking_to_wearer_subframes": ("audio video", "speech social.talking"),
    "social_native.social_segments": ("audio video", "speech social.looking social.talking"),
    "social_native.face_tracked_subframes": ("video", "speech face_tracks"),
    "social_native.face_track_bbox": ("video", "speech face_tracks"),
    "social_native.face_tracks": ("video", "speech face_tracks"),
    "metadata.source_offset": ("metadata", "meta.source_offset"),
    "metadata.background_conditions": ("metadata", "meta.background"),
    "metadata.participant_native_speaker": ("metadata", "meta.native_speaker"),
    "metadata.participant_is_host": ("metadata", "meta.host"),
} | dict.fromkeys((f"nuisance.{n}" for n in _FAMILIES["nuisance"][2].split()[:8]), ("audio", "media.audio"))


@dataclass(frozen=True)
class Label:
    """A label's name, with its family before the dot; all of its modalities are needed to use it, all of its facts to make it."""

    name: str
    modalities: tuple[str, ...]
    requires: tuple[str, ...] = ()

    @property
    def family(self) -> str:
        return self.name.split(".", 1)[0]


def _label(family: str, short: str) -> Label:
    modalities, requires = _OTHERS.get(f"{family}.{short}", _FAMILIES[family][:2])
    return Label(f"{family}.{short}", tuple(modalities.split()), tuple(requires.split()))


LABELS = tuple(_label(family, short) for family, (_, _, names) in _FAMILIES.items() for short in names.split())


class SelectionError(ValueError):
    """A selection names a label, family or modality that isn't there, or a label that can't be had."""


@dataclass(frozen=True)
class Selection:
    """The labels chosen, in the catalog's order, and those a wildcard reached in vain, with the reason."""

    names: tuple[str, ...] = ()
    skipped: Mapping[str, str] = field(default_factory=dict)


def catalog_errors(labels: Sequence[Label]) -> list[str]:
    """What is wrong with a catalog: names that are twice there or have no family, unknown facts and modalities."""
    out, seen = [], set()
    for label in labels:
        if label.name in seen:
            out.append(f"{label.name}: twice")
        seen.add(label.name)
        if not all(label.name.partition(".")[::2]):
            out.append(f"{label.name}: no family")
        if not label.modalities:
            out.append(f"{label.name}: no modality")
        out += [f"{label.name}: unknown modality {m}" for m in label.modalities if m not in MODALITIES]
        out += [f"{label.name}: unknown fact {f}" for f in label.requires if f not in FACTS]
    return out


def _unknown(kind: str, name: str, known: Iterable[str]) -> SelectionError:
    near = difflib.get_close_matches(name, list(known), n=3, cutoff=0.6)
    return SelectionError(f"unknown {kind} {name!r}" + (f"; did you mean {', '.join(near)}?" if near else ""))


def select_labels(include: Sequence[str], modalities: Sequence[str] = (), labels: Sequence[Label] = LABELS, supported: Iterable[str] | None = None) -> Selection:
    """The labels that `include` names: exactly, by family as in `timing.*`, or `all`; of these, those whose modalities are all among `modalities`, if any are given.

    A label named exactly must be there, pass the modalities, and be among `supported` if that is given; one reached by a
    family or `all` is left out by modalities, and skipped with a reason if it isn't supported. Unknown names are errors that name the nearest.
    """
    if not include:
        raise SelectionError("nothing is included; name labels, families as in 'timing.*', or 'all'")
    for m in modalities:
        if m not in MODALITIES:
            raise _unknown("modality", m, MODALITIES)
    by_name, families = {x.name: x for x in labels}, {x.family for x in labels}
    exact, wanted = set(), set()
    for item in include:
        if item == "all":
            wanted |= set(by_name)
        elif item.endswith(".*"):
            if item[:-2] not in families:
                raise _unknown("family", item[:-2], families)
            wanted |= {n for n, x in by_name.items() if x.family == item[:-2]}
        elif item in by_name:
            wanted.add(item)
            exact.add(item)
        else:
            raise _unknown("label", item, by_name)
    made = None if supported is None else set(supported)
    names, skipped = [], {}
    for name, label in by_name.items():
        if name not in wanted:
            continue
        if modalities and not set(label.modalities) <= set(modalities):
            if name in exact:
                raise SelectionError(f"{name} carries {', '.join(label.modalities)}, not all of which are among {', '.join(modalities)}")
        elif made is not None and name not in made:
            if name in exact:
                raise SelectionError(f"{name} isn't supported")
            skipped[name] = "not supported"
        else:
            names.append(name)
    return Selection(tuple(names), skipped)


def _texts(values: Sequence[str]) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def support_matrix(facts: DataFrame, labels: Sequence[Label] = LABELS) -> DataFrame:
    """(dataset, label, modalities, supported, missing): for each dataset and label whether the dataset provides all the label requires, and what lacks.

    `facts` are (dataset, fact), in any number and order; a dataset of null facts alone provides nothing.
    """
    each = F.explode(F.array(*(F.struct(F.lit(x.name).alias("label"), _texts(x.modalities).alias("modalities"), _texts(x.requires).alias("requires")) for x in labels)))
    rows = facts.groupBy("dataset").agg(F.collect_set("fact").alias("provides")).select("dataset", "provides", each.alias("l"))
    missing = F.array_sort(F.array_except("l.requires", "provides"))
    return rows.select("dataset", "l.label", "l.modalities", (F.size(missing) == 0).alias("supported"), missing.alias("missing"))


def modality_counts(support: DataFrame, made: DataFrame) -> DataFrame:
    """(dataset, modality, registered, supported, materialized): how many labels carry each modality, could be made, and are there as (dataset, label) in `made`."""
    there = made.select("dataset", "label").distinct().withColumn("_made", F.lit(True))
    rows = support.join(there, ["dataset", "label"], "left").withColumn("modality", F.explode("modalities"))
    return rows.groupBy("dataset", "modality").agg(F.count("*").alias("registered"), F.count_if("supported").alias("supported"), F.count("_made").alias("materialized"))
