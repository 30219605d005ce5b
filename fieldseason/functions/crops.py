"""Crop statistic expressions."""

# Crop names as the statistics source spells them.
CROP_NAMES = {
    "Corn": ("CORN",),
    "Soybeans": ("SOYBEANS", "SOYBEAN"),
    "Wheat": ("WHEAT",),
}


def parse_statistic(text: str) -> str:
    """Number in a statistic cell; codes such as ``(D)`` and blanks give null."""
    return f"try_cast(replace(trim({text}), ',', '') as double)"


def normalise_crop(name: str) -> str:
    cases = " ".join(
        f"when '{spelling}' then '{crop}'"
        for crop, spellings in CROP_NAMES.items()
        for spelling in spellings
    )
    return f"case trim(upper({name})) {cases} end"
