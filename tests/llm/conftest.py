import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
# Workers of a test session import the package from the checkout.
os.environ["PYTHONPATH"] = os.pathsep.join(
    [os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), os.environ.get("PYTHONPATH", "")]
)
