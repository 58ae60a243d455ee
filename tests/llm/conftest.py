import os
from pathlib import Path

ROOT = str(Path(__file__).resolve().parents[2])
# Python workers import the operators' modules by name.
if ROOT not in os.environ.get("PYTHONPATH", "").split(os.pathsep):
    os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])
