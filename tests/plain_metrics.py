"""The metric definitions once more, in plain Python, for comparison."""


def plain_metrics(track_id, text, segments):
    segments = segments or []
    total = segments[-1]["end"] if segments else 0.0
    words = []
    spoken = 0.0
    kept = 0
    for s in segments:
        prob = s["no_speech_prob"]
        if prob is not None and prob >= 0.6:
            continue
        kept += 1
        spoken += s["end"] - s["start"]
        words += s["text"].lower().split()
    return (
        track_id,
        len(text or ""),
        len(segments),
        total,
        spoken,
        spoken / total if total > 0 else 0.0,
        kept,
        len(words),
        len(set(words)),
    )
