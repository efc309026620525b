"""Option defaults of each stage."""

from __future__ import annotations

from tilewright.operators.manifest import channel_number

# Stage option defaults.
DEFAULTS = {
    "channels": "c0,c1",
    "stitching_channel": "all",
    "resolution": "0.23,0.23,0.42",
    "axis_mapping": "-x,y,z",
    "stitching_block_size": "128,128,64",
    "final_block_size_xy": 512,
    "stitching_mode": "incremental",
    "stitching_padding": "0,0,0",
    "stitching_blur_sigma": 2,
    "flatfield_correction": False,
    "flatfield_bins": 256,
    "matching_method": "phase",
    "search_radius": "4,4,4",
    "min_overlap": 64,
    "max_link_error": 1.0,
    "blending": True,
    "fill": True,
    "barrier_max_wait_secs": 7200,
}


def stage_options(**overrides) -> dict:
    """Defaults with overrides; an unknown name is an error, not a silent no-op."""
    unknown = sorted(set(overrides) - set(DEFAULTS))
    if unknown:
        raise ValueError(f"unknown options: {', '.join(unknown)}")
    return {**DEFAULTS, **overrides}


#: Which options each stage of the reconstruction reads.
STAGES = {
    "parse": ("resolution", "axis_mapping"),
    "convert": ("channels", "stitching_block_size"),
    "flatfield": ("flatfield_correction", "flatfield_bins"),
    "matching": ("channels", "stitching_channel", "stitching_blur_sigma"),
    "stitch": ("stitching_mode", "stitching_padding", "matching_method", "search_radius", "min_overlap", "max_link_error"),
    "export": ("resolution", "final_block_size_xy", "stitching_block_size", "blending", "fill"),
}


def options_of(stage: str, options: dict) -> dict:
    """The options that one stage reads, checked: a bad value is named before any data is read."""
    chosen = {name: options[name] for name in STAGES[stage]}
    for name in ("stitching_block_size", "stitching_padding", "search_radius"):
        if name in chosen:
            parts = int_vector(chosen[name])
            if min(parts) < (1 if name == "stitching_block_size" else 0):
                raise ValueError(f"{name} is too small: {chosen[name]!r}")
    if "stitching_mode" in chosen and chosen["stitching_mode"] not in ("full", "incremental"):
        raise ValueError(f"unknown stitching_mode {chosen['stitching_mode']!r}")
    if "stitching_blur_sigma" in chosen and chosen["stitching_blur_sigma"] < 0:
        raise ValueError("stitching_blur_sigma is negative")
    if "flatfield_bins" in chosen and not 1 <= chosen["flatfield_bins"] <= 65536:
        raise ValueError("flatfield_bins must be 1 to 65536")
    if "final_block_size_xy" in chosen and chosen["final_block_size_xy"] < 1:
        raise ValueError("final_block_size_xy must be positive")
    if "stitching_channel" in chosen:
        number = channel_number(chosen["stitching_channel"])
        if number is not None and number not in channel_list(chosen["channels"]):
            raise ValueError(f"stitching_channel {chosen['stitching_channel']!r} is none of {chosen['channels']!r}")
    return chosen


def channel_list(text: str) -> list[int]:
    """``'c0,c1'`` to channel numbers."""
    return [channel_number(name.strip()) for name in text.split(",")]


def int_vector(text: str) -> tuple[int, ...]:
    """``'128,128,64'`` to a tuple, in the x,y,z order the option uses."""
    parts = tuple(int(p) for p in text.split(","))
    if len(parts) != 3:
        raise ValueError(f"expected three comma-separated integers, got {text!r}")
    return parts
