"""Voice activity over chunks of sound as they arrive: what is open goes on in keyed state."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


@dataclass(frozen=True)
class VoiceRules:
    """threshold: least root mean square of a voiced chunk. silence: seconds of silence that end a stretch."""

    threshold: float = 0.01
    silence: float = 0.6


def voice_stream(chunks: DataFrame, rules: VoiceRules = VoiceRules()) -> DataFrame:
    """audio_id, start, end: stretches of voice, each as soon as it is over (append mode).

    chunks: audio_id, start (seconds), rate, samples (array of numbers), is_final; an audio's chunks of one batch are taken in order of start. State
    holds only the open stretch. A chunk without samples says nothing but may be final; after the final one an audio is forgotten.
    """

    def run(keys: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        begun, until = state.get if state.exists else (None, None)
        out, final = [], False
        for row in pd.concat(list(frames)).sort_values("start").itertuples():
            samples = np.asarray(row.samples if row.samples is not None else [], dtype=float)
            voiced = len(samples) > 0 and float(np.sqrt(np.mean(samples**2))) >= rules.threshold
            if begun is not None and row.start - until >= rules.silence:
                out.append((*keys, begun, until))
                begun = until = None
            if voiced:
                begun = row.start if begun is None else begun
                until = row.start + len(samples) / row.rate
            final = final or bool(row.is_final)
        if final:
            if begun is not None:
                out.append((*keys, begun, until))
            state.remove()
        elif begun is not None:
            state.update((float(begun), float(until)))
        elif state.exists:
            state.remove()
        yield pd.DataFrame(out, columns=["audio_id", "start", "end"])

    kind = dict(chunks.dtypes)["audio_id"]
    return chunks.groupBy("audio_id").applyInPandasWithState(run, f"audio_id {kind}, start double, end double", "begun double, until double", "append", GroupStateTimeout.NoTimeout)
