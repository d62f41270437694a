from tierline.operators import analysis, cleaning, quality, quarantine, star

__all__ = ["analysis", "cleaning", "quality", "quarantine", "star"]
